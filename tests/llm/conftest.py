"""Small folders of tables: every odd case at once, and empty ones."""

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = (
    "shard size slot kept label node key copies target text_key n_words host rank count one a b".split()
)


def prose(seed, n, line=12):
    chance = random.Random(seed)
    out = ["".join(chance.choice("abcdefgh") for _ in range(chance.randint(2, 9))) for _ in range(n)]
    return "\n".join(" ".join(out[i : i + line]) + "." for i in range(0, n, line))


def odd_documents():
    """Null, empty, blank and very long texts, copies, repeated rows, odd characters, null ids."""
    base, other = prose(1, 90), prose(2, 120)
    edited = base.split(" ")
    edited[40] = "changed"
    rows = [
        (10, base, "src0"),
        (11, base, "src1"),
        (3, base.upper(), None),
        (12, " ".join(edited), "src0"),
        (10, base, "src0"),
        (10, base, "src0"),
        (13, None, "src0"),
        (13, None, None),
        (14, "", "src2"),
        (15, " \t\n\x0b\x0c\r ", "src2"),
        (None, other, "src1"),
        (None, prose(3, 70), "src1"),
        (None, None, None),
        (16, other + "\n" + prose(4, 200), "src3"),
        (17, prose(5, 30) + "\n" + other, "src3"),
        (17, prose(6, 64), "src3"),
        (18, "one two three", "src4"),
        (19, "ONE two\tthree", "src4"),
        (20, "café 漢字 a b \U0001f600 #tag $5 <x>|y " * 20, "漢"),
        (21, "very long " + prose(7, 9000), "src5"),
        (22, "long again " + prose(7, 9000), "src5"),
        (23, "same same same same same " * 30, "src5"),
        (24, "x" * 5000, "src6"),
        (25, "\n".join(["a line that comes again and again in the very same words"] * 9), "src6"),
        (26, "TOO LOUD!! " * 60, "src6"),
        (-5, prose(8, 55), "src7"),
    ]
    return [(i, t, "en" if i else None, s, len(t) if t else None) for i, t, s in rows]


def odd_benchmark():
    other = prose(2, 120).split()
    return [
        (1, " ".join(other[20:60])),
        (2, " ".join(other[20:60]).upper()),
        (3, prose(99, 40)),
        (4, None),
        (5, " "),
        (6, "two three"),
        (None, prose(98, 25)),
        (7, "same same same same same same same same"),
    ]


def odd_conversations():
    return [
        (1, 0, "system", "be brief"),
        (1, 1, "user", "a question that is long enough"),
        (1, 2, "assistant", "an answer 漢 with \"quotes\" and a \\ and\ttabs"),
        (1, 3, "user", "short"),
        (1, 4, "assistant", ""),
        (1, 5, "user", "one more question without any answer"),
        (2, 1, "assistant", "nobody asked"),
        (3, 0, "user", "a question \U0001f600 with odd characters < > & /"),
    ]


def odd_labels():
    """Several rows for an id, nulls, ids that no document has."""
    return [
        (10, 1, 0),
        (10, 0, None),
        (11, 0, 1),
        (11, 0, 0),
        (17, 1, 1),
        (20, None, None),
        (26, 1, 1),
        (-5, 1, 0),
        (99, 1, 1),
        (None, 1, 1),
    ]


def write(spark, folder, documents, benchmark, conversations, labels):
    for name, rows, schema in (
        ("labels", labels, "doc_id long, quality long, toxic long"),
        ("documents", documents, DOCUMENTS),
        ("benchmark", benchmark, "item_id long, text string"),
        ("conversations", conversations, "conv_id long, turn long, role string, text string"),
    ):
        spark.createDataFrame(rows, schema).coalesce(2).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    return write(spark, folder, odd_documents(), odd_benchmark(), odd_conversations(), odd_labels())


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), [], [], [], [])


@pytest.fixture(scope="session")
def clashing(spark, odd):
    """The odd documents with further columns that bear the operators' own names."""
    frame = spark.read.parquet(f"{odd}/documents.parquet")
    return frame.selectExpr("*", *(f"concat('{name}', doc_id) AS `{name}`" for name in CLASHING))

