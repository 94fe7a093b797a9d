"""Incremental preparation: dedup spans micro-batches, counters accumulate."""

import json

from quarry.plans.options import PrepareOptions
from quarry.streaming import incremental as INC


def _write(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows), encoding="utf-8")


def test_incremental_prepare(spark, tmp_path):
    raw, out, ckpt = tmp_path / "raw", tmp_path / "out", tmp_path / "ckpt"
    raw.mkdir()
    a = "Pierwszy dokument. " * 20
    b = "Drugi dokument. " * 20
    _write(raw / "s1.jsonl", [{"text": a, "source": "s1"}, {"text": "krotki"}, {"text": a}])
    opts = PrepareOptions(min_chars=50)
    INC.start(spark, str(raw), str(out), str(ckpt), opts).awaitTermination()
    t = INC.totals(spark, str(out)).collect()[0]
    assert (t.seen, t.kept, t.dropped_short, t.dropped_dup) == (3, 1, 1, 1)

    # a later shard repeats a (after whitespace normalization) and brings b
    _write(raw / "s2.jsonl", [{"text": "  " + a + "\n", "source": "s2"}, {"text": b, "source": "s2"}, "not json"])
    INC.start(spark, str(raw), str(out), str(ckpt), opts).awaitTermination()
    t = INC.totals(spark, str(out)).collect()[0]
    assert (t.seen, t.kept, t.dropped_short, t.dropped_dup) == (5, 2, 1, 2)
    kept = spark.read.json(str(out / "rows")).collect()
    assert sorted(r.text[:5] for r in kept) == ["Drugi", "Pierw"]
