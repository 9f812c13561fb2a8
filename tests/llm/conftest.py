import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, row long, key string, n long"


@pytest.fixture(scope="session")
def spark():
    from demandlab.session import local_session
    s = local_session(4, shuffle_partitions=4, driver_memory="4g")
    yield s
    s.stop()


def texts(seed: int = 3, n: int = 60) -> list:
    """Ids and texts with copies, near copies, shared passages, NULLs, ties, empty and long ones."""
    r = random.Random(seed)
    words = ["the", "of", "and", "Ärger", "été", "x1", "don't", "we'll", "it's", "A!!", "niño", "42", "&&&", "—dash—", "ſ", "日本"]
    words += ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(60)]
    passage = " ".join(r.choice(words) for _ in range(90))
    out = []
    for i in range(n):
        t = " ".join(r.choice(words) + r.choice(["", "", ".", ",\n"]) for _ in range(r.randint(0, 120)))
        if i % 7 == 3:
            t = t[:80] + " " + passage + " " + t[80:]
        if i % 11 == 5:
            t = out[i - 3][1] or ""
        if i % 13 == 6 and out[i - 1][1]:
            w = out[i - 1][1].split(" ")
            w[len(w) // 2] = "changed"
            t = " ".join(w)
        out.append((i * 3 % 101, t))
    out += [(500, None), (501, ""), (502, "   \n\t"), (503, "one"), (504, "one two"), (505, "One  two"), (None, "a row without id and some words"),
            (out[4][0], out[4][1]), (506, "long " * 4000 + passage), (507, ("ab " * 900).strip()), (508, "x" * 3000)]
    return out


def frame(spark, rows):
    """Rows of (doc_id, text) with further columns whose names operators use inside."""
    langs, sources = ["en", "de", None], ["src0", "src1", "src5", "other", None]
    wide = [(i, t, langs[k % 3], sources[k % 5], len(t) if t else 0, "s", k, "k", k) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(wide, SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return texts()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """Written and read back: some operators scan their input twice."""
    import tempfile
    path = tempfile.mkdtemp() + "/docs"
    frame(spark, rows).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
