import math
import random

from orelake.llm.importance import gram_models, importance_resample, target_sample, top_threshold
from tests.llm.helpers import empty, make, nasty, text

GOOD, BAD = "clear plain useful river stone".split(), "junk spam noise buy now".split()


def corpus(spark, n=200):
    rng = random.Random(4)
    say = lambda w: " ".join(rng.choice(w) for _ in range(60))
    rows = [(i, say(GOOD) if i % 4 else say(BAD)) for i in range(n)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(n // 2)], "doc_id long, quality int, toxic int")
    return make(spark, rows), labels


def test_selects_documents_like_the_target(spark):
    docs, labels = corpus(spark)
    got = {r.doc_id: r for r in importance_resample(docs, labels).collect()}
    assert sum(r.kept for r in got.values()) == 150
    assert all(got[i].kept == (i % 4 > 0) for i in got)
    assert min(got[i].log_weight for i in got if i % 4) > 0 > max(got[i].log_weight for i in got if i % 4 == 0)
    assert got[0].n_grams == 119


def test_log_ratio_equals_plain_counts(spark):
    docs = make(spark, [(1, "A b a"), (2, "b c")])
    target = spark.createDataFrame([(1,)], "doc_id long")
    r = gram_models(docs, target, buckets=1 << 16, smooth=0.5)
    # raw: 5 words and 3 pairs, scaled to the target's 3 and 2; "a" is there twice, "c" not in the target
    want = {round(math.log(t + .5) - math.log(n * 5 / 8 + .5), 9) for t, n in ((2, 2), (1, 2), (0, 1), (1, 1), (0, 0))}
    assert {round(x, 9) for x in r.tolist()} == want


def test_gumbel_sample_follows_the_weights(spark):
    # equal weights: the kept set is a uniform sample that depends on the seed, not on row order
    docs = make(spark, [(i, "same text") for i in range(400)])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    kept = lambda d, s: {r.doc_id for r in importance_resample(d, labels, seed=s).collect() if r.kept}
    one, two = kept(docs, 1), kept(docs, 2)
    assert len(one) == len(two) == 200 and one != two and kept(docs.repartition(3), 1) == one


def test_target_sample_takes_the_worst_label(spark):
    rows = [(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, 1, 0), (None, 1, 0), (4, None, 0), (5, 1, None), (3, 1, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    assert [r.doc_id for r in target_sample(labels).collect()] == [3]


def test_top_threshold_is_exact(spark):
    rng = random.Random(9)
    values = [rng.gauss(0, 100) for _ in range(500)] + [5.0] * 50 + [-1e300, 1e300, 5.000000000000001]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for k in (1, 2, 40, 275, 552, 553):
        assert top_threshold(df, "v", k) == sorted(values, reverse=True)[k - 1]
    assert top_threshold(df, "v", 0) is None and top_threshold(df, "v", 554) is None


def test_odd_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([(7, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int")
    got = importance_resample(make(spark, nasty()), labels).collect()
    assert len(got) == len(nasty()) and len({(r.n_grams, r.log_weight, r.key, r.kept) for r in got if r.doc_id == 7}) == 1
    none = labels.limit(0)
    assert importance_resample(empty(spark), labels).count() == 0
    assert not any(r.kept for r in importance_resample(make(spark, [(1, text(1, 9))]), none).collect())
