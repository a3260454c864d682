"""The key-bucket layout gives the same table as the flat layout under random changes."""

import json
import random

from recordtable.plans.commands import RecordStore


def _table(store):
    cols = [c for c in store.table().columns if c not in ("_bucket", "processed_date")]
    return sorted(tuple(r) for r in store.table().select(*cols).collect())


def test_random_changes_same_under_both_layouts(spark, tmp_path):
    rng = random.Random(11)
    flat = RecordStore(spark, str(tmp_path / "flat"))
    bucketed = RecordStore(spark, str(tmp_path / "bucketed"), buckets=5)
    seq = 0
    for step in range(6):
        kind = ["add", "add", "update", "delete", "add", "update"][step]
        if kind == "add":
            rows = []
            for _ in range(rng.randint(3, 12)):
                seq += 1
                doc = {"id": rng.randint(0, 30), "localized_name": f"n{rng.randint(0, 99)}",
                       "base_health": rng.randint(100, 900), "roles": ["a", "b"][: rng.randint(0, 2)]}
                rows.append((seq, json.dumps(doc)))
            batch = spark.createDataFrame(rows, "seq long, json string")
            r1 = sorted((r.seq, r.reason) for r in flat.add(batch).collect())
            r2 = sorted((r.seq, r.reason) for r in bucketed.add(batch).collect())
        elif kind == "update":
            rows = []
            for _ in range(rng.randint(3, 12)):
                seq += 1
                doc = rng.choice([{"base_health": rng.randint(0, 9)}, {"move_speed": "300"},
                                  {"localized_name": None}, {"roles": ["x"]}])
                rows.append((rng.randint(0, 35), seq, json.dumps(doc)))
            batch = spark.createDataFrame(rows, "hero_id long, seq long, json string")
            r1 = sorted(tuple(r) for r in flat.update(batch).collect())
            r2 = sorted(tuple(r) for r in bucketed.update(batch).collect())
        else:
            keys = spark.createDataFrame([(rng.randint(0, 35),) for _ in range(8)], "hero_id long")
            r1 = sorted(tuple(r) for r in flat.delete(keys).collect())
            r2 = sorted(tuple(r) for r in bucketed.delete(keys).collect())
        assert r1 == r2, (step, kind)
        assert _table(flat) == _table(bucketed), (step, kind)
    assert len(_table(flat)) > 0
