"""Change operators against a plain-Python sequential reference on random batches.

Each batch has a hot key holding about a third of its rows, in-batch
duplicates, NULL keys and (for patches) explicit nulls and absent fields.
Both the broadcast and the shuffle path are checked.
"""

import json
import random

import pytest

from conftest import rows
from recordtable.fields import Field
from recordtable.operators.change import delete, insert_new, patch, upsert

SEEDS = [1, 2, 3]
PATHS = {"broadcast": 2_000_000, "shuffle": None}
HOT = 7


def make_table(rng):
    keys = rng.sample(range(0, 40), 25) + [HOT]
    return [(k, rng.randint(0, 9), rng.choice(["x", "y", "z"])) for k in sorted(set(keys))]


def make_batch(rng, n=60):
    out = []
    for seq in rng.sample(range(1000), n):
        r = rng.random()
        k = HOT if r < 0.34 else (None if r < 0.40 else rng.randint(0, 60))
        out.append((k, rng.randint(0, 99), rng.choice(["p", "q", "r"]), seq))
    return out


def ref_upsert(table, batch):
    t = {k: (k, a, b) for k, a, b in table}
    for k, a, b, seq in sorted((r for r in batch if r[0] is not None), key=lambda r: r[3]):
        t[k] = (k, a, b)
    return sorted(t.values())


def ref_insert(table, batch):
    t = {k: (k, a, b) for k, a, b in table}
    result = dict(t)
    rejected = []
    seen = set()
    for k, a, b, seq in sorted(batch, key=lambda r: (r[3])):
        if k is None:
            rejected.append((k, seq, "null_key"))
        elif k in seen:
            rejected.append((k, seq, "duplicate_in_batch"))
        else:
            seen.add(k)
            if k in t:
                rejected.append((k, seq, "key_exists"))
            else:
                result[k] = (k, a, b)
    return sorted(result.values()), rejected


def tsort(xs):
    return sorted(xs, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("path", PATHS)
def test_upsert_and_insert_match_reference(spark, seed, path):
    rng = random.Random(seed)
    table, batch = make_table(rng), make_batch(rng)
    t = spark.createDataFrame(table, "k long, a int, b string")
    b = spark.createDataFrame(batch, "k long, a int, b string, seq long")
    bound = PATHS[path]
    assert rows(upsert(t, b, "k", "seq", max_broadcast_rows=bound)[0]) == tsort(ref_upsert(table, batch))
    result, rejected = insert_new(t, b, "k", "seq", max_broadcast_rows=bound)
    want_result, want_rejected = ref_insert(table, batch)
    assert rows(result) == tsort(want_result)
    assert rows(rejected.select("k", "seq", "reason")) == tsort(want_rejected)


FIELDS = (Field("a", "int"), Field("b", "text"))


def make_patches(rng, n=60):
    out = []
    for seq in rng.sample(range(1000), n):
        r = rng.random()
        k = HOT if r < 0.34 else (None if r < 0.40 else rng.randint(0, 60))
        doc = {}
        if rng.random() < 0.6:
            doc["a"] = rng.choice([None, rng.randint(0, 99), str(rng.randint(0, 99)), "x", True])
        if rng.random() < 0.6:
            doc["b"] = rng.choice([None, "s", 5, ["l"]])
        text = json.dumps(doc) if rng.random() > 0.05 else "{broken"
        out.append((k, seq, text))
    return out


def coerce_a(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    if isinstance(v, str):
        try:
            return int(float(v))
        except ValueError:
            return 0
    return 0


def coerce_b(v):
    if v is None or isinstance(v, (list, dict)):
        return ""
    return str(v)


def ref_patch(table, patches):
    t = {k: [k, a, b] for k, a, b in table}
    missing = []
    for k, seq, text in sorted(patches, key=lambda r: r[1]):
        if k is None or k not in t:
            missing.append((k, seq, text))
            continue
        try:
            doc = json.loads(text)
        except ValueError:
            continue
        if "a" in doc:
            t[k][1] = coerce_a(doc["a"])
        if "b" in doc:
            t[k][2] = coerce_b(doc["b"])
    return sorted(tuple(v) for v in t.values()), missing


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("path", PATHS)
def test_patch_matches_sequential_reference(spark, seed, path):
    rng = random.Random(seed)
    table, patches = make_table(rng), make_patches(rng)
    t = spark.createDataFrame(table, "k long, a int, b string")
    p = spark.createDataFrame(patches, "k long, seq long, j string")
    result, missing = patch(t, p, "k", "seq", "j", FIELDS, max_broadcast_rows=PATHS[path])
    want, want_missing = ref_patch(table, patches)
    assert rows(result) == tsort(want)
    assert rows(missing) == tsort(want_missing)


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("path", PATHS)
def test_delete_matches_reference(spark, seed, path):
    rng = random.Random(seed)
    table = make_table(rng)
    keys = [(HOT,)] * 10 + [(rng.randint(0, 60),) for _ in range(20)] + [(None,)]
    t = spark.createDataFrame(table, "k long, a int, b string")
    kd = spark.createDataFrame(keys, "k long")
    result, missing = delete(t, kd, "k", max_broadcast_rows=PATHS[path])
    gone = {k for (k,) in keys if k is not None}
    assert rows(result) == tsort([r for r in table if r[0] not in gone])
    present = {r[0] for r in table}
    assert rows(missing) == tsort([(k,) for (k,) in keys if k is not None and k not in present])
