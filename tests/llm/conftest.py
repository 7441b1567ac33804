"""Documents with awkward rows, shared by the tests of this folder."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, _key string, items int"


def prose(rng, words, alphabet="abcdefgh"):
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 7))) for _ in range(words))


@pytest.fixture(scope="session")
def awkward(spark):
    """Null and empty texts, null ids, ties, repeated rows, a long text, clashing column names."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(1, 60)) for _ in range(40)]
    line = "a line that stands in many documents, Over And Over"
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i].replace(" ", " \t\n"), None, None) for i in range(5)]
    rows += [(110 + i, f"{prose(rng, 9)}\n  {line.upper() if i % 2 else line}\t\n{line}", "de", "s1") for i in range(8)]
    rows += [(200, None, None, None), (201, "", "", ""), (202, " \n\t ", "en", "s0"), (203, None, "en", "s9")]
    rows += [(None, texts[0], None, "s0"), (None, line, "de", "s0"), (5, texts[5], "en", "s2"), (5, texts[5], "en", "s2")]
    rows += [(300, prose(rng, 90_000), "en", "s0"), (301, "x" * 70_000, "en", "s0"), (302, "12 34 !! éЖ中", "ru", "s4")]
    rows = [(i, t, g, s, None if t is None else len(t), 7, "own", 3) for i, t, g, s in rows]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def tables(spark, tmp_path):
    """Write tables into a folder as the queries read them."""

    def put(**frames):
        for name, df in frames.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return put


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
