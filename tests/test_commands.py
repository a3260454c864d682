"""The original tool's command flow on a stored table: download, list, view, find, stats, query, add, update, delete."""

import json
import os

import pytest

from recordtable.plans.commands import RecordStore
from recordtable.sources.files import read_documents

HEROES = [
    {"id": 1, "name": "npc_1", "localized_name": "Anti-Mage", "base_health": 200, "base_mana": 75,
     "base_attack_min": 29, "base_attack_max": 33, "move_speed": 310, "primary_attr": "agi",
     "roles": ["Carry", "Escape", "Nuker"]},
    {"id": 2, "localized_name": "Axe", "base_health": 200, "base_mana": 75, "move_speed": 310,
     "primary_attr": "str", "roles": ["Initiator"]},
    {"id": 3, "localized_name": "Bane", "base_health": 200, "base_mana": "75", "move_speed": 305,
     "primary_attr": "int"},
    {"id": 4, "localized_name": "Magnus", "move_speed": 305, "primary_attr": "str"},
]


@pytest.fixture(params=[None, 8], ids=["flat", "buckets"])
def store(spark, tmp_path, request):
    land = tmp_path / "land"
    os.makedirs(land)
    (land / "heroes.json").write_text(json.dumps(HEROES))
    s = RecordStore(spark, str(tmp_path / "hero_stats"), buckets=request.param)
    r = s.download(read_documents(spark, str(land), layout="whole"))
    assert r.rows_loaded == 4 and r.rejects == 0
    return s


def test_reads(store):
    assert [r.hero_name for r in store.list(2).collect()] == ["Anti-Mage", "Axe"]
    assert store.list(2).columns[:2] == ["hero_id", "hero_name"]
    assert store.view_one(3).collect()[0].base_mana == 75
    assert [r.hero_id for r in store.find("a").collect()] == [1, 3, 4]   # case-sensitive like
    assert [r.hero_id for r in store.find("A").collect()] == [1, 2]
    assert [r.hero_id for r in store.find("A", ignore_case=True).collect()] == [1, 2, 3, 4]
    stats = {r.primary_attribute: r for r in store.stats().collect()}
    assert stats["str"].hero_count == 2 and stats["str"].avg_speed == 307.5
    assert store.stats().columns == ["primary_attribute", "hero_count", "avg_health", "avg_mana", "avg_speed"]
    q = store.query("SELECT hero_id FROM heroes WHERE move_speed > :s", {"s": 306})
    assert sorted(r.hero_id for r in q.collect()) == [1, 2]
    assert store.count().collect()[0].rows == 4


def test_add_update_delete(spark, store):
    adds = spark.createDataFrame(
        [(1, '{"id": 5, "localized_name": "Pudge", "roles": ["Disabler"]}'),
         (2, '{"id": 5, "localized_name": "Pudge 2"}'),
         (3, '{"id": 2, "localized_name": "Axe again"}'),
         (4, '{"localized_name": "No id"}')],
        "seq long, json string",
    )
    rejected = {r.seq: r.reason for r in store.add(adds).collect()}
    assert rejected == {2: "duplicate_in_batch", 3: "key_exists", 4: "null_key"}
    t = {r.hero_id: r for r in store.table().collect()}
    assert set(t) == {1, 2, 3, 4, 5} and t[5].hero_name == "Pudge" and t[5].roles == "Disabler"
    assert t[5].base_health == 0 and t[5].processed_date is not None

    patches = spark.createDataFrame(
        [(1, 1, '{"base_health": 700, "move_speed": 320, "id": 99}'),
         (1, 2, '{"roles": ["Carry", "Pusher"], "primary_attr": null}'),
         (42, 1, '{"base_health": 1}')],
        "hero_id long, seq long, json string",
    )
    missing = store.update(patches)
    assert [r.hero_id for r in missing.collect()] == [42]
    h1 = store.view_one(1).collect()[0]
    assert (h1.base_health, h1.move_speed, h1.roles, h1.primary_attribute, h1.base_mana) == (700, 320, "Carry,Pusher", "", 75)

    keys = spark.createDataFrame([(1,), (77,)], "hero_id long")
    missing = store.delete(keys)
    assert [r.hero_id for r in missing.collect()] == [77]
    assert sorted(r.hero_id for r in store.table().collect()) == [2, 3, 4, 5]


def test_bucketed_change_rewrites_only_touched_buckets(spark, tmp_path):
    from pyspark.sql import functions as F

    from recordtable.sources.layout import BUCKET_COL

    land = tmp_path / "land"
    os.makedirs(land)
    many = [{"id": i, "localized_name": f"H{i:03d}", "move_speed": 300 + i % 7,
             "primary_attr": ["agi", "str", "int"][i % 3]} for i in range(200)]
    (land / "h.json").write_text(json.dumps(many))
    s = RecordStore(spark, str(tmp_path / "t"), buckets=16)
    s.download(read_documents(spark, str(land), layout="whole"))

    def files():
        out = {}
        for d in sorted(os.listdir(s.path)):
            if d.startswith(BUCKET_COL):
                out[d] = sorted(f for f in os.listdir(os.path.join(s.path, d)) if f.endswith(".parquet"))
        return out

    before = files()
    assert len(before) == 16
    assert all(len(v) == 1 for v in before.values())  # one file per bucket
    patches = spark.createDataFrame([(7, 1, '{"base_health": 999}')], "hero_id long, seq long, json string")
    s.update(patches)
    after = files()
    assert BUCKET_COL not in s.view_one(7).columns and BUCKET_COL not in s.table().columns
    bucket7 = s.raw_table().where("hero_id = 7").select(BUCKET_COL).collect()[0][0]
    changed = {d for d in before if before[d] != after.get(d)}
    assert changed == {f"{BUCKET_COL}={bucket7}"}
    assert all(len(v) == 1 for v in after.values())
    # a change touching every bucket still leaves one file per bucket
    everyone = spark.createDataFrame([(i, 2, '{"move_speed": 1}') for i in range(200)], "hero_id long, seq long, json string")
    s.update(everyone)
    assert all(len(v) == 1 for v in files().values())
    assert s.table().where("move_speed = 1").count() == 200
    assert s.view_one(7).collect()[0].base_health == 999
    assert s.table().count() == 200
    # delete every key of one bucket: the bucket directory goes away
    keys = s.raw_table().where(F.col(BUCKET_COL) == bucket7).select("hero_id")
    s.delete(keys)
    assert f"{BUCKET_COL}={bucket7}" not in files()
    assert s.raw_table().where(F.col(BUCKET_COL) == bucket7).count() == 0
    plan = s.view_one(8)._jdf.queryExecution().executedPlan().toString()
    assert s.view_one(8).collect()[0].hero_id == 8
    assert "PartitionFilters: [isnotnull(_bucket" in plan


@pytest.mark.parametrize("buckets", [None, 4], ids=["flat", "buckets"])
def test_first_add_creates_table(spark, tmp_path, buckets):
    s = RecordStore(spark, str(tmp_path / "new_table"), buckets=buckets, report_dir=str(tmp_path / "reports"))
    with pytest.raises(FileNotFoundError):
        s.delete(spark.createDataFrame([(1,)], "hero_id long"))
    adds = spark.createDataFrame([(1, '{"id": 9, "localized_name": "Nine"}'), (2, '{"id": 9}')], "seq long, json string")
    rejected = s.add(adds)
    assert [(r.seq, r.reason) for r in rejected.collect()] == [(2, "duplicate_in_batch")]
    assert [(r.hero_id, r.hero_name) for r in s.table().collect()] == [(9, "Nine")]
    assert s.view_one(9).count() == 1
    assert any(d.startswith("rejected-") for d in os.listdir(tmp_path / "reports"))


def test_checked_batches_refuse_repeated_seq(spark, tmp_path):
    s = RecordStore(spark, str(tmp_path / "t"))
    s.add(spark.createDataFrame([(1, '{"id": 1}')], "seq long, json string"), check=True)
    bad = spark.createDataFrame([(1, 5, '{"base_health": 1}'), (1, 5, '{"base_health": 2}')],
                                "hero_id long, seq long, json string")
    with pytest.raises(ValueError):
        s.update(bad, check=True)
    assert s.view_one(1).collect()[0].base_health == 0
    s.update(bad)  # unchecked: the (seq, hash) order picks one patch, the same one every time
    assert s.view_one(1).collect()[0].base_health in (1, 2)
