"""A change log with operations that choose their points by a filter: the staged fold equals the operations one by one."""

import random

import pytest

from pointframe.operators.mutate import apply_staged_changelog
from pointframe.sources.collection import make_collection

ROW = "id long, vec array<float>, a int, b int"


def plain(rows, events, ops):
    state = {r[0]: dict(zip(("vec", "a", "b"), r[1:], strict=True)) for r in rows}
    todo = sorted([(e["seq"], 0, k, e) for k, e in enumerate(events)] + [(o["seq"], 1, k, o) for k, o in enumerate(ops)], key=lambda x: x[:3])
    for _, kind, _, e in todo:
        if kind == 0:
            if e["op"] == "upsert":
                state[e["id"]] = {"vec": e["vec"], "a": e["a"], "b": e["b"]}
            elif e["op"] == "delete":
                state.pop(e["id"], None)
            elif e["id"] in state:
                state[e["id"]].update({k: e[k] for k in "ab" if e[k] is not None})
            continue
        name = next(k for k in e if k != "seq")
        key, low = e[name]["filter"]["must"][0]["key"], e[name]["filter"]["must"][0]["range"]["gte"]
        for i in [i for i, r in state.items() if r[key] is not None and r[key] >= low]:
            if name == "delete":
                del state[i]
            elif name == "set_payload":
                state[i].update(e[name]["payload"])
            else:
                state[i].update({"a": None, "b": None})
    return {(i, tuple(r["vec"]), r["a"], r["b"]) for i, r in state.items()}


@pytest.mark.parametrize("seed", range(3))
def test_staged_fold_equals_the_operations_one_by_one(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [float(i)], rng.randrange(10), rng.randrange(10)) for i in range(30)]
    events = []
    for n in rng.sample(range(200), 60):
        op = rng.choice(["upsert", "delete", "set_payload", "set_payload"])
        full = op == "upsert"
        events.append({"id": rng.randrange(40), "vec": [float(n)] if full else None, "a": rng.randrange(10) if full or rng.random() < 0.7 else None,
                       "b": rng.randrange(10) if full else None, "seq": n, "op": op})
    cond = lambda: {"filter": {"must": [{"key": rng.choice("ab"), "range": {"gte": rng.randrange(5, 10)}}]}}
    ops = [{"seq": rng.randrange(-5, 220), **rng.choice([{"delete": cond()}, {"set_payload": {"payload": {"a": rng.randrange(10)}, **cond()}},
                                                        {"clear_payload": cond()}])} for _ in range(7)]
    coll = make_collection(spark.createDataFrame(rows, ROW), id="id", vectors={"": ("vec", 1, "Dot")})
    log = spark.createDataFrame([tuple(e[k] for k in ("id", "vec", "a", "b", "seq", "op")) for e in events], ROW + ", seq long, op string")
    got = apply_staged_changelog(coll, log, ops, checkpoint_every=3).df
    assert {(r.id, tuple(r.vec), r.a, r.b) for r in got.collect()} == plain(rows, events, ops)
    parents = got._jdf.queryExecution().toString()
    assert parents.count("_stage") < 2000 and "ExistingRDD" in parents  # the plan starts from the last checkpoint


def test_operations_that_are_refused(spark):
    coll = make_collection(spark.createDataFrame([(1, [1.0], 1, 1)], ROW), id="id", vectors={"": ("vec", 1, "Dot")})
    log = spark.createDataFrame([], ROW + ", seq long, op string")
    for bad in ({"delete": {"filter": {"must": []}}}, {"seq": 1, "upsert": {"points": log}}, {"seq": 1, "delete": {"points": [1]}},
                {"seq": 1, "delete": {"filter": {"must": []}}, "clear_payload": {}}):
        with pytest.raises(ValueError):
            apply_staged_changelog(coll, log, [bad])
    odd = spark.createDataFrame([(1, None, None, None, 1, "delete_payload", ["c"])], ROW + ", seq long, op string, keys array<string>")
    from pointframe.operators.mutate import apply_changelog
    with pytest.raises(Exception, match="unknown names in keys"):
        apply_changelog(coll, odd).df.collect()
