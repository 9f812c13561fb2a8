import os

import pytest
from pyspark.sql import functions as F

from demandlab.operators import sampling, stats
from demandlab.sources import io


def test_csv_round_trip_and_materialize(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, None)], "k int, s string, v double")
    path = str(tmp_path / "p.csv")
    io.write_panel(df, path, fmt="csv")
    back = io.read_panel_csv(spark, path, df.schema).orderBy("k").collect()
    assert [tuple(r) for r in back] == [(1, "a", 1.5), (2, None, None)]
    m = io.materialize(df, "t_demo")
    assert m.count() == 2 and spark.table("t_demo").count() == 2
    prof = io.profile(df, n=1, order_by=["k"])
    assert prof["rows"] == 2 and prof["shape"] == (2, 3) and prof["head"][0]["k"] == 1


def test_ordered_write(spark, tmp_path):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 as k", "id")
    path = str(tmp_path / "o")
    io.write_panel(df, path, order_by=["k"], files=4)
    parts = sorted(p for p in __import__("os").listdir(path) if p.endswith(".parquet"))
    import pyarrow.parquet as pq
    ks = [k for p in parts for k in pq.read_table(f"{path}/{p}").column("k").to_pylist()]
    assert ks == sorted(ks) and len(ks) == 1000


def test_checkpoint_dir_is_shared_setting(spark):
    from demandlab.session import ensure_checkpoint_dir
    d = ensure_checkpoint_dir(spark)
    assert d == spark.conf.get("spark.checkpoint.dir") and os.path.isdir(d)


def test_split_and_folds_depend_on_key_only(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = {r.k: (r.is_test, r.fold) for r in
         sampling.with_fold(sampling.split(df, ["k"], 25), ["k"], 5).collect()}
    b = {r.k: (r.is_test, r.fold) for r in
         sampling.with_fold(sampling.split(df.repartition(7), ["k"], 25), ["k"], 5).collect()}
    assert a == b
    share = sum(v[0] for v in a.values()) / len(a)
    assert 0.2 < share < 0.3 and {v[1] for v in a.values()} == set(range(5))
    tr, te = sampling.train_test(sampling.split(df, ["k"], 25))
    assert tr.count() + te.count() == 2000


def test_value_counts_non_finite(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("b", float("inf"))], "c string, v double")
    assert [(r.c, r["count"]) for r in stats.value_counts(df, "c").collect()] == [("a", 2), ("b", 1)]
    assert stats.non_finite(df, ["v"]).first().v == 2
    cs = stats.column_stats(spark.createDataFrame([(1.0,), (3.0,)], "v double"), ["v"]).first()
    assert (cs.max_v, cs.min_v, cs.mean_v) == (3.0, 1.0, 2.0)


def test_exact_quantiles_hot_group_ties_and_rounds(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(0)
    n = 20000
    g = np.where(rng.random(n) < 0.34, "hot", np.array(["a", "b"])[rng.integers(0, 2, n)])
    v = np.concatenate([rng.lognormal(size=n // 2), np.round(rng.normal(size=n - n // 2), 1)])
    v[rng.random(n) < 0.01] = np.nan
    pdf = pd.DataFrame({"g": g, "v": v})
    res = stats.exact_quantiles(spark.createDataFrame(pdf), "v", [0.0, 0.25, 0.5, 0.333, 1.0], by="g").collect()
    assert len(res) == 15
    for r in res:
        ref = pdf[pdf.g == r.g].v.dropna().quantile(r.q)
        assert r.value == pytest.approx(ref, rel=1e-12, abs=1e-12)


def test_exact_quantiles_ungrouped_and_all_null_group(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(5)
    v = np.round(rng.normal(size=5000), 2)
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    res = {r.q: r.value for r in stats.exact_quantiles(df, "v", [0.1, 0.5, 0.9]).collect()}
    for q, val in res.items():
        assert val == pytest.approx(pd.Series(v).quantile(q), rel=1e-12, abs=1e-12)
    g = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "g string, v double")
    d = {r.g: r for r in stats.describe_by(g, ["v"], by="g").collect()}
    assert d["a"].p50 == 2.0 and d["b"].p50 is None and d["b"]["count"] == 0


def test_exact_quantiles_heavy_ties(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(1)
    v = np.where(rng.random(5000) < 0.5, 1.0, 2.0)
    v[:50] = rng.normal(size=50)
    pdf = pd.DataFrame({"v": v})
    for r in stats.exact_quantiles(spark.createDataFrame(pdf), "v", [0.25, 0.4999, 0.75]).collect():
        assert r.value == pytest.approx(pdf.v.quantile(r.q), rel=1e-12, abs=1e-12)


class _Conf(dict):
    def set(self, k, v):
        self[k] = v


class _Context:
    def __init__(self, held=None, setting=None, master="local[2]"):
        self.held, self.setting, self.master = held, setting, master

    def getCheckpointDir(self):
        return self.held

    def setCheckpointDir(self, d):
        self.held = d + "/inner"

    def getConf(self):
        return {"spark.checkpoint.dir": self.setting} if self.setting else {}


class _Session:
    def __init__(self, **kw):
        self.sparkContext, self.conf = _Context(**kw), _Conf()


def test_checkpoint_folder_order(tmp_path, monkeypatch):
    import pytest

    from demandlab.session import ensure_checkpoint_dir, scratch_table
    assert ensure_checkpoint_dir(_Session(held="/user/chose")) == "/user/chose"
    assert ensure_checkpoint_dir(_Session(held="/user/chose", setting="/shared")) == "/user/chose"
    assert ensure_checkpoint_dir(_Session(held="file:/shared/1-2", setting="file:///shared")) == "file:///shared"
    s = _Session(setting="hdfs://x/shared", master="yarn")
    assert ensure_checkpoint_dir(s) == "hdfs://x/shared" and s.sparkContext.held == "hdfs://x/shared/inner"
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    assert ensure_checkpoint_dir(_Session()).startswith(str(tmp_path))
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError):
            ensure_checkpoint_dir(_Session(master=master))
    a, b = (scratch_table(_Session(held="/d/"), "t") for _ in range(2))
    assert a != b and a.startswith("/d/t-")


def test_exact_quantiles_many_groups(spark):
    """200,000 groups of three values each: no limit on groups, nothing through the driver."""
    n = 200_000
    df = spark.range(3 * n).select((F.col("id") % n).alias("g"), (F.floor(F.col("id") / n) * 10 + F.col("id") % n).cast("double").alias("v"))
    got = stats.exact_quantiles(df, "v", [0.5, 0.75], by="g")
    off = got.select(F.col("g").cast("long").alias("g"), "q", (F.col("value") - F.col("g").cast("long")).alias("x"))
    assert {(r.q, r.x): r["count"] for r in off.groupBy("q", "x").count().collect()} == {(0.5, 10.0): n, (0.75, 15.0): n}


def test_exact_quantiles_hot_and_null_groups(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"g": np.where(rng.random(20_000) < 0.6, "hot", rng.integers(0, 50, 20_000).astype(str)), "v": rng.normal(size=20_000).round(3)})
    pdf.loc[rng.random(20_000) < 0.02, "g"] = None
    pdf.loc[rng.random(20_000) < 0.05, "v"] = None
    got = {(r.g, r.q): r.value for r in stats.exact_quantiles(spark.createDataFrame(pdf).repartition(7), "v", [0, 0.1, 0.5, 0.99, 1], by="g").collect()}
    for g, part in pdf.groupby("g", dropna=False).v:
        for q in (0, 0.1, 0.5, 0.99, 1):
            assert got[None if g != g or g is None else g, float(q)] == pytest.approx(part.quantile(q), rel=1e-12, abs=1e-15)


@pytest.mark.parametrize("parts", [1, 6])
def test_corr_matrix_wide_by_group(spark, parts):
    import time

    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(9)
    k, n = 300, 1200
    X = rng.normal(size=(n, k)) + rng.normal(size=(n, 1)) * rng.random(k) + 1e6 * (np.arange(k) == 4)
    X[rng.random((n, k)) < 0.1] = np.nan
    X[:, 7] = 3.0
    pdf = pd.DataFrame(X, columns=[f"x{i}" for i in range(k)]).assign(g=rng.integers(0, 3, n))
    pdf.loc[pdf.g == 2, "x9"] = np.nan
    t0 = time.time()
    got = stats.corr_matrix(spark.createDataFrame(pdf).repartition(parts), [f"x{i}" for i in range(k)], by="g").toPandas()
    assert time.time() - t0 < 60
    for g, part in pdf.groupby("g"):
        want = part.drop(columns="g").corr().to_numpy()
        have = got[got.g == g].pivot(index="a", columns="b", values="corr").loc[[f"x{i}" for i in range(k)], [f"x{i}" for i in range(k)]].to_numpy()
        assert np.allclose(want, have, atol=1e-9, equal_nan=True)
