from collections import Counter

from llm.lines import normalise
from llm.queries import op5_lines


def test_equal_lines_of_any_length_stay_once(spark, documents, tmp_path):
    lines = ["And ornd.", "x", "雪が降る夜に猫が静かに歩いていました", "two words", "", "...", "a line with quite enough words here"]
    texts = ["\n".join(lines), "\n".join(reversed(lines)), "AND ornd\nX!\n\nx\ny", "two words\n雪が降る夜に猫が静かに歩いていました。\n..."]
    documents(texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in op5_lines(spark, str(tmp_path)).collect()}
    left = Counter(line for r in got.values() for line in normalise(r["text"]) if line)
    assert left == Counter({line for t in texts for line in normalise(t) if line})
    assert got[0]["text"] == texts[0] and got[1]["text"] == "...\n" and got[2]["text"] == "\ny" and got[3]["text"] == "..."
    assert [got[k]["n_removed"] for k in range(4)] == [0, 5, 3, 2]
