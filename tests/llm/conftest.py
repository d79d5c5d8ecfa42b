import duckdb
import pytest

from tests.test_oracle import multiset

#: Nulls, empty and wordless texts, ties, repeated rows, copies, and a very long text.
LONG = " ".join(f"Word{i % 977}x{i}" for i in range(30_000))
TEXTS = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one two"), (5, "one two"), (5, "one two"),
    (6, "Ünïcode Größe \U0001f600 naïve\ncafé au lait et plus encore\nfin"), (7, LONG), (8, LONG + " end"),
    (9, "%%% *** 123"), (10, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (11, "A B C D E F G H I J K L M N O P Q R S T U V W X Y Z"),
    (None, "a b c d e f g h i j k l m n o p q r s t u v w x y z"), (None, None),
    (12, "café au lait et plus encore\nfin\nanother line of some words here"),
]
#: Names the operators use inside.
EXTRA = ("id", "run", "sha", "rows", "size", "target", "region", "hit", "component", "label",
         "check", "pos", "parcel", "shard", "match", "postings", "_hit", "_id", "_gone", "key",
         "bucket", "_mix_id", "_mix_taken", "_answer")


def documents(spark, rows):
    """A table like ``documents`` with extra columns of clashing names."""
    data = [(i, t, None if i == 3 else "en", None if i in (1, 10) else f"s{(i or 0) % 3}",
             None if t is None else len(t), *[f"extra{i}"] * len(EXTRA)) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{c} string" for c in EXTRA)
    return spark.createDataFrame(data, schema).repartition(3)


@pytest.fixture(scope="session")
def odd(spark):
    return documents(spark, TEXTS)


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def odd_turns(spark):
    """Turns with nulls, ties, repeated rows, control strings and columns of clashing names."""
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, None, None, "\\ <turn x>"),
            (2, 5, "assistant", "### User: </turn> \\\\ <|im_start|>"), (2, 5, "assistant", ""),
            (2, 5, "system", "é\U0001f600"), (None, 1, "assistant", "a\nb>\n"), (None, None, None, None),
            (3, 1, "a>\n</turn>\n", LONG), (4, 2, "", "")]
    clash = [f"{c} string" for c in ("part", "log", "whole", "loss", "seq", "kind", "message")]
    return spark.createDataFrame([(*r, *["x"] * len(clash)) for r in rows],
                                 "conv_id long, turn long, role string, text string, " + ", ".join(clash))


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables and gives their folder."""
    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.fixture
def agrees():
    """Whether a query's rows are those of its SQL."""
    def check(df, sql, folder):
        con = duckdb.connect()
        for name in ("documents", "benchmark", "pages", "labels", "conversations"):
            for pattern in (f"{folder}/{name}.parquet", f"{folder}/{name}.parquet/*.parquet"):
                try:
                    con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{pattern}'")
                    break
                except duckdb.Error:
                    continue
        result = con.execute(sql)
        names, wanted = multiset([d[0] for d in result.description], result.fetchall())
        got_names, got = multiset(df.columns, [tuple(r) for r in df.collect()])
        assert got_names == names
        assert got == wanted

    return check
