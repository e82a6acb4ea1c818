import pytest

#: Columns whose names the operators use inside or return.
CLASHING = ("size", "kept", "node", "_taken", "label", "votes", "score", "digest", "n", "key", "gone", "_source", "position", "features")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
LONG = ("lorem ipsum dolor sit amet consectetur " * 20 + "\n") * 60


def rows_of_edge():
    base = [
        (1, "One two three four five six seven eight nine ten.", "en", "a", 3),
        (2, None, "en", "a", None), (3, "", None, None, 0), (4, LONG, "en", "b", 1),
        (5, "One two three four five six seven eight nine ten.", "en", "b", 3),
        (6, "same", "en", "b", 3), (6, "same", "en", "b", 3),  # a repeated row
        (7, "   \n\t ", "en", "c", 3), (None, "No id at all here, my friend.", "en", None, 3),
        (None, "No id at all here, my friend.", "en", None, 3), (8, "same", "en", None, None),
        (9, "x" * 50_000, "en", "c", 3), (10, " " * 40_000 + "end", "en", "c", 3),
        (11, "Zoë \U0001F600 naïve é  nbsp\x1c!", "fr", "a", 3),
        (-5, "One two three four five six seven eight nine ten.", "en", "z", 3),
    ]
    return [r + tuple(f"v{i}" if r[0] is None or r[0] % 2 else None for i in range(len(CLASHING))) for r in base]


@pytest.fixture
def edge(spark):
    return spark.createDataFrame(rows_of_edge(), SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture
def frame(spark):
    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in zip(ids, texts)],
                                     "doc_id long, text string, lang string, source string, n_chars long")

    return make
