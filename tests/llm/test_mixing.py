import collections

import pytest

from orelake.llm.mixing import mix_sources, mixed_documents, schedule
from tests.llm.helpers import empty, make, nasty, text


def blocks(rows):
    out = {}
    for r in rows:
        out[r.source, r.block] = r
    return out.values()


def check(rows, weights, parts):
    """Less than one block from the fluid share at every slot of the full periods; windows kept; slots used once."""
    b = sorted(blocks(rows), key=lambda r: r.slot)
    assert len({r.slot for r in b}) == len(b)
    assert all(r.release <= r.slot < r.deadline for r in b)
    total = sum(weights.values())
    share = {s: max(1, round(parts * w / total)) for s, w in weights.items()}
    period = sum(share.values())
    count = collections.Counter(r.source for r in b)
    full = min(count[s] // share[s] for s in share) * period
    done, at = collections.Counter(), 0
    for r in b:
        if r.slot >= full:
            break
        assert r.slot == at
        done[r.source] += 1
        at += 1
        for s in share:
            assert abs(done[s] - at * share[s] / period) < 1
    return full


def docs(spark, sizes):
    i, rows = 0, []
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((i, "x" * 10, s))
            i += 1
    return make(spark, rows)


@pytest.mark.parametrize("weights,parts", [({"a": 5, "b": 3, "c": 2}, 10), ({"a": 1, "b": 1, "c": 1}, 20), ({"a": 90, "b": 9, "c": 1}, 100)])
def test_deviation_below_one_block(spark, weights, parts):
    rows = mix_sources(docs(spark, {"a": 300, "b": 200, "c": 150}), weights, block_chars=10, parts=parts).collect()
    assert len(rows) == 650
    assert check(rows, weights, parts) > 0


def test_many_sources_and_default_weights(spark):
    rows = mix_sources(docs(spark, {f"s{i}": 10 + 3 * i for i in range(12)}), block_chars=10, parts=64).collect()
    assert len(rows) == sum(10 + 3 * i for i in range(12)) and len({r.slot for r in rows}) == len(rows)
    assert sorted(r.slot for r in rows) == list(range(len(rows)))      # all blocks placed, no slot left out


def test_odd_rows_native_plan_and_empty(spark):
    rows = [(*r, s) for r, s in zip(nasty(), [None, "", "a", "b", None, "a", "hot", "a", "a", "b", "c", "c", "c", "null"])]
    df = mix_sources(make(spark, rows), block_chars=1000, parts=20)
    got = df.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert {r.source for r in got} == {r[2] for r in rows}
    assert all(r.release <= r.slot < r.deadline for r in blocks(got))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert mix_sources(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        mix_sources(make(spark, rows), {"a": 0})


def test_mixed_documents_keep_rows_and_come_in_order(spark):
    d = make(spark, [(i, text(i, 5 + i % 50), f"s{i % 3}") for i in range(300)])
    out = mixed_documents(d, {"s0": 2, "s1": 1, "s2": 1}, block_chars=50, parts=8)
    assert out.columns == d.columns
    got = out.collect()
    assert sorted(got) == sorted(d.collect())
    first = collections.Counter(r.source for r in got[:80])
    assert first["s0"] > first["s1"] and mixed_documents(empty(spark)).count() == 0


def fluid(n, w, v):
    return sum(min(n[k], w[k] * v) for k in n)


@pytest.mark.parametrize("weights,parts", [
    ({"a": 2, "b": 1}, 100), ({"a": 2 ** 0.5, "b": 1, "c": 3 ** 0.5}, 10), ({"a": 1, "b": 0.3, "c": 0.0007}, 100),
    ({f"s{i:03}": 1 for i in range(60)}, 25), ({f"s{i:03}": 1.37 ** (i % 20) for i in range(40)}, 1000)])
def test_deviation_from_true_weights_below_one_block(spark, weights, parts):
    """At every slot, against the unrounded weights while all sources last, then against the fluid mix of the rest."""
    total = sum(weights.values())
    n = {k: max(1, int(6000 * w / total * (1 + i % 3 / 4))) for i, (k, w) in enumerate(weights.items())}
    sizes = spark.createDataFrame([(f"s:{k}", x) for k, x in n.items()], "key__ string, n long")
    rows = sorted(schedule(sizes, weights, parts).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(sum(n.values()))) and all(r.period == r.slot // parts for r in rows)
    done, v, most = collections.Counter(), 0.0, 0
    first = fluid(n, weights, min(n[k] / weights[k] for k in n))
    for at, r in enumerate(rows):
        assert r.block == done[r.key__] and r.release <= r.slot < r.deadline
        done[r.key__] += 1
        lo, hi = v, v + 2 * max(n[k] / weights[k] for k in n)
        for _ in range(60):                      # the virtual time at which the fluid mix has given at + 1 slots
            v = (lo + hi) / 2
            lo, hi = (v, hi) if fluid(n, weights, v) < at + 1 else (lo, v)
        most = max([most] + [abs(done[f"s:{k}"] - min(n[k], weights[k] * v)) for k in n])
        if at + 1 <= first:
            most = max([most] + [abs(done[f"s:{k}"] - (at + 1) * w / total) for k, w in weights.items()])
    assert done == {f"s:{k}": x for k, x in n.items()} and 0 < most < 1 + 1e-5


def test_the_number_of_blocks_is_bounded(spark):
    rows = mix_sources(docs(spark, {"a": 300, "b": 100}), block_chars=10, parts=8, most_blocks=40).collect()
    assert len(rows) == 400 and sorted({r.slot for r in rows}) == list(range(40))


def test_a_minute_weight_makes_no_empty_periods(spark):
    sizes = spark.createDataFrame([("s:a", 300), ("s:b", 40)], "key__ string, n long")
    rows = schedule(sizes, {"a": 1.0, "b": 1e-9}, 10).collect()
    assert sorted(r.slot for r in rows) == list(range(340)) and min(r.slot for r in rows if r.key__ == "s:b") == 300
