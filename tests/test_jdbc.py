"""Range planning against tables of an embedded engine; no database server is used."""

from __future__ import annotations

import duckdb
import pytest

from payrisk import jobs
from payrisk.sources import jdbc


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    connection.sql("CREATE TABLE even AS SELECT range AS id FROM range(10000)")
    # Ids with a gap, most rows in a hundredth of the range, and rows without id.
    connection.sql(
        "CREATE TABLE skewed AS SELECT range AS id FROM range(9000) UNION ALL "
        "SELECT 900000 + range * 100 FROM range(990) UNION ALL SELECT NULL FROM range(10)"
    )
    connection.sql("CREATE TABLE keys AS SELECT 'PAY-' || range AS id FROM range(20000)")
    connection.sql(
        "CREATE TABLE hot AS SELECT 'it''s' AS id FROM range(6000) UNION ALL SELECT 'k' || range FROM range(3000)"
    )
    connection.sql("CREATE TABLE nothing AS SELECT NULL::BIGINT AS id FROM range(5)")
    return connection


def sizes(engine, table, partitions):
    asked = []

    def run(query):
        asked.append(query)
        return engine.sql(query).fetchall()

    predicates = jdbc.plan_ranges(run, table, "id", partitions)
    counts = [engine.sql(f"SELECT count(*) FROM {table} WHERE {p}").fetchall()[0][0] for p in predicates]
    return counts, asked


@pytest.mark.parametrize("table", ["even", "skewed", "keys"])
@pytest.mark.parametrize("partitions", [1, 7, 32])
def test_ranges_are_even_and_complete(engine, table, partitions):
    counts, asked = sizes(engine, table, partitions)
    rows = engine.sql(f"SELECT count(*) FROM {table}").fetchall()[0][0]
    assert sum(counts) == rows and len(counts) == partitions
    assert max(counts) <= 1.6 * rows / partitions + 10
    assert asked[0].startswith("SELECT MIN(id), MAX(id)") and len(asked) < 4 + 2 * partitions


def test_one_busy_value_is_a_range_of_its_own(engine):
    counts, _ = sizes(engine, "hot", 9)
    assert sum(counts) == 9000 and max(counts) == 6000
    assert sum(sorted(counts)[:-1]) == 3000 and max(sorted(counts)[:-1]) <= 2000


def test_columns_without_values_are_one_range(engine):
    assert sizes(engine, "nothing", 4)[0] == [5]


def test_predicates_and_literals():
    assert jdbc.range_predicates("id", [3, 9]) == ["(id < 3 OR id IS NULL)", "id >= 3 AND id < 9", "id >= 9"]
    assert jdbc.literal("it's\\") == "'it''s\\'" and jdbc.literal("a\\", True) == "'a\\\\'"
    for value in (None, True, b"x"):
        with pytest.raises(TypeError):
            jdbc.literal(value)
    with pytest.raises(ValueError):
        jdbc.plan_ranges(lambda q: [], "t", "id", 0)


def test_reader_gets_the_ranges(monkeypatch):
    """The options and predicates that Spark's reader would get."""
    seen = {}

    class Rows:
        def __init__(self, rows):
            self.rows = rows

        def collect(self):
            return self.rows

    class Reader:
        def format(self, name):
            assert name == "jdbc"
            return self

        def options(self, **options):
            seen.setdefault("queries", []).append(options["query"])
            self.query = options["query"]
            assert options["url"] == "jdbc:mysql://h/db" and options["user"] == "u"
            return self

        def load(self):
            first = "GROUP BY" not in self.query
            return Rows([(0, 99, 100)] if first else [(i, i + 9, 10) for i in range(0, 100, 10)])

        def jdbc(self, url, table, predicates, properties):
            seen.update(url=url, table=table, predicates=predicates, properties=properties)
            return "frame"

    class Spark:
        read = Reader()

    assert jdbc.read_ranges(Spark(), "jdbc:mysql://h/db", "t", "id", 2, user="u") == "frame"
    assert seen["predicates"] == ["(id < 50 OR id IS NULL)", "id >= 50"]
    assert seen["properties"] == {"fetchsize": "10000", "user": "u"} and seen["table"] == "t"

    calls = []
    monkeypatch.setattr(jobs, "read_ranges", lambda *a, **o: calls.append((a[1:], o)))
    monkeypatch.setattr(jobs, "require_rows", lambda df, what: (_ for _ in ()).throw(StopIteration))
    with pytest.raises(StopIteration):
        jobs.insights(None, "r", "fraud_features", "out", features_url="jdbc:x", connections="8")
    assert calls == [(("jdbc:x", "fraud_features", "transaction_id", 8), {})]
