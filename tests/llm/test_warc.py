import hashlib

import pytest
import zstandard
from pyspark.sql import functions as F

from llm import warc
from llm.warc import archived, records


def test_round_trip_with_revisits(spark):
    long = "<p>é</p>" * 40
    html = {5: long, 3: long, 9: long, 1: "short", 2: "short", 4: None, 6: "", 7: "a\r\n\r\nb" * 30, 8: "x" * 3_000_000}
    html |= {k: f"<html>{k}</html>" * 30 for k in range(20, 60)}
    rows = [(k, f"http://e/{k}\r\nX: y", h) for k, h in html.items()] + [(None, None, long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    got = archived(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        payload = (long if r["page_id"] is None else html[r["page_id"]] or "").encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
        again = r["page_id"] in (5, 9, None)
        assert (r["record_type"], r["refers_to"]) == (("revisit", 3) if again else ("response", None))
    assert archived(pages.limit(0)).count() == 0
    assert callable(records)


def test_an_archive_is_read_in_steps_and_once(spark, monkeypatch):
    given = []

    class Decoder:
        def __init__(self, inner):
            self.inner = inner

        def decompress(self, piece):
            given.append(len(piece))
            return self.inner.decompress(piece)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    real = zstandard.ZstdDecompressor

    class Codec:
        def __init__(self, **options):
            self.inner = real(**options)

        def decompressobj(self):
            return Decoder(self.inner.decompressobj())

    texts = [hashlib.sha256(str(k).encode()).digest() * (k % 7) + bytes(range(256)) * (k % 40) for k in range(2000)]
    codec = zstandard.ZstdCompressor(level=1)
    archive = warc.dictionary_frame(b"") + b"".join(map(codec.compress, texts))
    with monkeypatch.context() as patch:
        patch.setattr(warc.zstandard, "ZstdDecompressor", Codec)
        assert list(records(archive)) == texts
    assert sum(given) < len(archive) + len(texts) * 5000
    with pytest.raises(ValueError):
        list(records(archive[:-5]))
    scans = []
    whole = warc.read
    monkeypatch.setattr(warc, "read", lambda *a, **k: scans.append(whole(*a, **k)) or scans[-1])
    pages = spark.createDataFrame([(k, "http://e", f"<p>{k % 30}</p>" * 30) for k in range(60)], "page_id long, url string, html string")
    found = archived(pages)
    assert found.count() == 60 and "payload" not in scans[0].columns
    assert "binaryFile" not in found._jdf.queryExecution().toString()
