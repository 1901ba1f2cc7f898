import re
import zlib

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, "
    "key string, n double, words string, doc string, node int, component int, copies int, mark string"
)


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def bucket(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def sample(n=40):
    """Texts with copies, near copies, shared lines, blanks, odd characters and repeats."""
    rows, base = [], [f"w{k}x{(k * k) % 97}" for k in range(300)]
    for i in range(n):
        body = base[(i * 37) % 200 : (i * 37) % 200 + 30 + i]
        if i % 5 == 1:
            body = list(base[10:110])
            body[i % 90] = f"edit{i}"
        lines = [" ".join(body[k : k + 12]) for k in range(0, len(body), 12)]
        if i % 4 == 0:
            lines.insert(1, "this line of eleven words stands in a good many texts")
        if i % 7 == 3:
            lines += lines[:2] + ["", " \t", "Ünï çødé 漢字 😀 don't 's"]
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, source): nulls, empties, repeated rows, ties, and one very long text."""
    rows = [(i, t, f"s{i % 3}") for i, t in sample()]
    rows += [(100, None, "s0"), (101, "", "s1"), (102, " \n\t ", None), (103, rows[2][1], None)]
    rows += [(3, rows[3][1], rows[3][2])] * 2
    rows += [(104, "lone", "s2"), (105, "lone", "s2"), (106, "a b c d", "s1"), (107, "A B\tc  d", "s1")]
    rows += [(108, "tail " * 4000 + "end", "s0"), (109, "x" * 3000, "s2"), (110, "y" * 99, "s2")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    extra = (1, "a", "b", 0.5, "c", "d", 1, 2, 3, "e")
    found = [(d, t, "en", s, None if t is None else len(t), *extra) for d, t, s in odd_rows]
    return spark.createDataFrame(found, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def null_docs(spark):
    """Rows in which every column may be null."""
    nothing = (None,) * 12
    return spark.createDataFrame(
        [(None, None, None, *nothing), (None, "some text of no document", None, *nothing), (1, None, None, *nothing)], SCHEMA
    )
