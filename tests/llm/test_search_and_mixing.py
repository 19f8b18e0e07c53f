"""Exact top-k search, source mixing, and the SQL of both."""

import glob
import hashlib
import math
import os
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlens.llm import bitsliced_topk, queries, source_mixing

from . import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sql, name):
    found = queries.QUERIES[name](spark, SF).toPandas()
    wanted = sql.sql(queries.ORACLES[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    as_rows = lambda df: sorted(map(str, df[columns].itertuples(index=False, name=None)))
    assert as_rows(found) == as_rows(wanted)


def brute(rows, asked, k):
    ok = lambda v: v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)
    whole = lambda v: np.array([math.floor(256 * x) for x in v])
    out = set()
    for q, v in asked:
        if q is None or not ok(v):
            continue
        scores = sorted((-int(whole(v) @ whole(w)), i) for i, w in rows if i is not None and i != q and ok(w) and len(w) == len(v))
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize(("seed", "bits", "block"), [(1, 7, 16_384), (2, 3, 10), (3, 1, 64), (4, 12, 33)])
def test_topk_equals_brute_force(spark, seed, bits, block):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in np.float32(rng.choice([-1, -0.5, 0, 0.25, rng.normal()], 6))]) for i in range(150)]
    rows += [(200, None), (201, []), (202, [None] * 6), (203, [float("nan")] * 6), (204, [float("inf")] * 6), (205, [1.0, 2.0]), (206, [2.0, 1.0]), (None, [1.0] * 6), (207, [0.0] * 6), (208, [1000.0] * 6)]
    rows += [(300 + i, rows[7][1]) for i in range(20)]  # ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("dim", F.lit("x")).withColumn("id", F.lit(0))
    config = bitsliced_topk.TopkConfig(kept_bits=bits, block_rows=block, block_queries=7)
    asked = df.filter("vec_id % 10 = 0 or vec_id > 200")
    found = bitsliced_topk.top_k(df, asked, config=config).collect()
    wanted = brute(rows, [r for r in rows if r[0] is not None and (r[0] % 10 == 0 or r[0] > 200)], 5)
    assert {tuple(r) for r in found} == wanted and len(found) == len(wanted)
    assert bitsliced_topk.top_k(df.limit(0), df.limit(0)).collect() == []


def test_slices_bound_the_scores():
    rng = np.random.default_rng(6)
    values = rng.integers(-300, 300, (500, 9))
    for bits in (1, 4, 20):
        index = bitsliced_topk.SlicedIndex(values, bits)
        for query in rng.integers(-300, 300, (5, 9)):
            slices, offset, unit, slack = index.sum_slices(query)
            total = sum((np.unpackbits(s.view(np.uint8), count=500, bitorder="little").astype(np.int64) << b for b, s in enumerate(slices) if s is not None), np.zeros(500, np.int64))
            low, exact = offset + unit * total, values @ query
            assert (low <= exact).all() and (exact <= low + slack).all()
            if bits == 20:
                assert (low == exact).all()


def plain_mixing(docs, config):
    """How often each document comes, from sorted documents of each source."""
    tokens, rows = Counter(), defaultdict(list)
    for d, t, s in docs:
        s = "\0null" if s is None else s
        own = hashlib.md5("|".join([config.seed, "" if d is None else str(d)]).encode()).hexdigest()
        block = hashlib.md5("|".join([config.seed, s, own[:2]]).encode()).hexdigest()
        rows[s].append((block[:8] + own, len(plain.words(t)), d))
        tokens[s] += len(plain.words(t))
    total = sum(tokens.values())
    share = {s: n / total for s, n in tokens.items() if n}
    power = 1.0
    for k in range(source_mixing.GRID + 1) if len(share) < 2 else [math.ceil((1 - math.log(config.max_repetition) / math.log(max(share.values()) / min(share.values()))) * source_mixing.GRID)]:
        power = max(0, k) / source_mixing.GRID
        break
    raised = {s: x**power for s, x in share.items()}
    least = min((raised[s] / share[s] for s in share), default=1)
    out = Counter()
    for s, own in rows.items():
        times = round(raised[s] / share[s] / least, 9) if s in share else 1
        rest, used, stop = math.floor((times - math.floor(times)) * tokens[s]), 0, False
        groups = defaultdict(list)
        for key, n, d in own:
            groups[key].append((n, d))
        for key in sorted(groups):
            used += sum(n for n, _ in groups[key])
            stop = stop or used > rest or not rest
            for _, d in groups[key]:
                out[d, s] += math.floor(times) + (0 if stop else 1)
    return out


@pytest.mark.parametrize("limit", [1.2, 2.0, 3.7])
def test_mixing_equals_plain(spark, limit):
    rng = random.Random(int(limit * 10))
    docs = [(i, " ".join(["w"] * rng.randint(1, 30)), rng.choice("aaaaaaaaaabbbbccd")) for i in range(400)]
    docs += [(1000, None, "a"), (1001, "", "b"), (None, "x y", "c"), (1002, "one two", None), (5, "again", "a"), (1003, None, "empty")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("key", F.lit(1)).withColumn("weight", F.lit(2)).withColumn("row", F.lit("x"))
    config = source_mixing.MixConfig(max_repetition=limit)
    rows = source_mixing.mixed(df, config=config).collect()
    found = Counter((r["row"]["doc_id"], "\0null" if r["row"]["source"] is None else r["row"]["source"]) for r in rows)
    assert found == plain_mixing(docs, config)
    assert {r["row"]["doc_id"] for r in rows} == {d for d, _, _ in docs}  # nothing is lost
    assert source_mixing.mixed(df.limit(0)).collect() == []


def test_exponent_meets_the_targets(spark):
    shares = spark.createDataFrame([(0.7,), (0.2,), (0.06,), (0.04,)], "share double")
    p = [0.7, 0.2, 0.06, 0.04]

    def entropy(power):
        raised = [x**power for x in p]
        z = sum(raised)
        return -sum(x / z * math.log(x / z) for x in raised) / math.log(len(p))

    for target in (0.7, 0.9, 0.99):
        power = source_mixing.exponent(shares, source_mixing.MixConfig(max_repetition=None, target_entropy=target))
        assert entropy(power) <= target + 1e-9 < entropy(power - 2 / source_mixing.GRID) + 2e-7
    power = source_mixing.exponent(shares, source_mixing.MixConfig(max_repetition=4.0))
    times = [x**power / x for x in p]
    assert max(times) / min(times) <= 4.0 + 1e-9
    assert source_mixing.exponent(shares.limit(0), source_mixing.MixConfig()) in (0.0, 1.0)
