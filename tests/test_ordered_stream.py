"""Files in any order, and delivered twice, give the table of one ordered batch."""

import json
import random

import pytest

from recordtable.fields import Contract, Field
from recordtable.plans.commands import RecordStore
from recordtable.streaming.ordered_stream import start_ordered_stream

FIELDS = (Field("k", "long", default=None), Field("name", "text"), Field("n", "int"), Field("d", "double"), Field("l", "list"))
CONTRACT = Contract(key="k", not_null=("k",), max_len={"name": 12}, load_ts="at")
SCHEMA = "op string, seq long, k long, json string"


def content(store):
    return sorted((tuple(r) for r in store.table().select("k", "name", "n", "d", "l").collect()), key=str)


def random_changes(rng, keys, n):
    out = []
    for seq in range(n):
        k = rng.choice(keys)
        op = rng.choice(["add", "add", "update", "update", "update", "delete"])
        doc = {"k": k, "name": f"n{rng.randint(0, 99)}", "n": rng.choice([seq, str(seq), None]), "d": seq / 4, "l": ["a", seq]}
        doc = {c: doc[c] for c in doc if c == "k" or rng.random() < 0.6}
        out.append((op, seq, k, None if op == "delete" else json.dumps(doc)))
    return out


def land(folder, rows):
    folder.mkdir(exist_ok=True)
    return lambda name, part: (folder / f"{name}.json").write_text(
        "\n".join(json.dumps({"op": o, "seq": s, "k": k, "json": j}) for o, s, k, j in part)
    )


def stream(store, tmp_path, files):
    q = start_ordered_stream(store, str(tmp_path / "land"), str(tmp_path / "ckpt"), max_files_per_trigger=files)
    q.awaitTermination(240)
    assert q.exception() is None


@pytest.mark.parametrize(("seed", "buckets"), [(1, None), (2, 4)])
def test_any_order_of_files(spark, tmp_path, seed, buckets):
    rng = random.Random(seed)
    # one key has a third of the changes; two keys are in the table before
    rows = random_changes(rng, [*range(9), 3, 3, 3, 3], 120)
    before = [("add", -2, 3, json.dumps({"k": 3, "name": "old", "n": 5})), ("add", -1, 4, json.dumps({"k": 4, "n": 6}))]
    whole = RecordStore(spark, str(tmp_path / "whole"), FIELDS, CONTRACT, buckets=buckets)
    whole.apply(spark.createDataFrame(before, SCHEMA))
    moved = RecordStore(spark, str(tmp_path / "moved"), FIELDS, CONTRACT, buckets=buckets)
    moved.apply(spark.createDataFrame(before, SCHEMA))
    whole.apply(spark.createDataFrame(rows, SCHEMA))

    shuffled = rows[:]
    rng.shuffle(shuffled)
    put = land(tmp_path / "land", shuffled)
    for i in range(4):
        put(f"a{i}", shuffled[i::5])
    stream(moved, tmp_path, 2)
    # a late file, and files that were delivered before
    put("late", shuffled[4::5])
    put("again", shuffled[0::5] + shuffled[1::5])
    stream(moved, tmp_path, 1)
    assert content(moved) == content(whole) and content(whole)


def test_late_patches_and_contract(spark, tmp_path):
    store = RecordStore(spark, str(tmp_path / "t"), FIELDS, CONTRACT)
    put = land(tmp_path / "land", [])
    put("1", [("update", 9, 1, '{"n": 9}'), ("add", 5, 1, '{"k": 1, "n": 5, "name": "five"}'), ("add", 1, 2, '{"k": 2, "name": "much too long for it"}')])
    stream(store, tmp_path, 1)
    assert content(store) == [(1, "five", 9, 0.0, None)]
    # older than what is there; a name too long, so the add's row stands; a row without seq
    put("2", [("update", 7, 1, '{"n": 7, "d": 7}'), ("add", 3, 1, '{"k": 1, "n": 3}'), ("add", 1, 5, '{"k": 5, "n": 1}')])
    put("3", [("update", 4, 5, '{"name": "much too long for it"}'), ("add", None, 6, '{"k": 6}'), ("other", 1, 7, '{"k": 7}')])
    stream(store, tmp_path, 1)
    assert content(store) == [(1, "", 9, 7.0, None), (5, "", 1, 0.0, None)]
    put("4", [("delete", 8, 1, None), ("delete", 2, 5, None), ("update", 10, 1, '{"n": 10}')])
    stream(store, tmp_path, 1)
    assert content(store) == []
    put("5", [("add", 11, 1, '{"k": 1, "n": 1}'), ("update", 12, 1, '{"n": 2}')])
    stream(store, tmp_path, 1)
    assert content(store) == [(1, "", 2, 0.0, None)]


def test_state_partitions_follow_the_buckets(spark, tmp_path):
    put = land(tmp_path / "land", [])
    put("a", [("add", 1, 7, json.dumps({"k": 7, "name": "a"}))])
    store = RecordStore(spark, str(tmp_path / "t"), FIELDS, CONTRACT, buckets=3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stream(store, tmp_path, None)
    assert [r.k for r in store.table().collect()] == [7]
    assert len([d for d in (tmp_path / "ckpt" / "state" / "0").iterdir() if d.name.isdigit()]) == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before != "3"


def test_changes_are_read_once_and_kept_by_aggregates(spark, tmp_path):
    rng = random.Random(8)
    rows = random_changes(rng, [*range(6), 2, 2], 80)
    store = RecordStore(spark, str(tmp_path / "t"), FIELDS, CONTRACT, buckets=2)
    store.apply(spark.createDataFrame([("add", -2, 2, '{"k": 2, "n": 1}'), ("add", -1, 50, '{"k": 50, "n": 2}')], SCHEMA))
    at = store.table().where("k = 50").first()["at"]
    whole = RecordStore(spark, str(tmp_path / "whole"), FIELDS, CONTRACT)
    whole.apply(spark.createDataFrame([("add", -2, 2, '{"k": 2, "n": 1}'), ("add", -1, 50, '{"k": 50, "n": 2}'), *rows], SCHEMA))
    put = land(tmp_path / "land", [])
    for i in range(3):
        put(f"a{i}", rows[i::3])
    q = start_ordered_stream(store, str(tmp_path / "land"), str(tmp_path / "ckpt"), max_files_per_trigger=2)
    q.awaitTermination(240)
    assert q.exception() is None and content(store) == content(whole)
    progress = [p for p in q.recentProgress if p["numInputRows"]]
    assert sum(p["numInputRows"] for p in progress) == len(rows) + 2  # each landed row, and the table at the start, once
    assert {o["operatorName"] for p in progress for o in p["stateOperators"]} == {"stateStoreSave"}
    assert store.table().where("k = 50").first()["at"] == at  # no change named it
