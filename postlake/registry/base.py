"""How a query is registered, and the common table expressions the SQL side shares."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import fixtures
from postlake.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
PARTS: dict[str, tuple[str, tuple[str, ...]]] = {}  # the SQL of a query and what it builds on

CTES = {
    "post_src": fixtures.POST_SRC_DUCKDB,
    "tok": """
SELECT id, kind, name FROM (
  SELECT id, 'general' AS kind, unnest(string_split(tag_string_general, ' ')) AS name FROM post_src
  UNION ALL
  SELECT id, 'character', unnest(string_split(tag_string_character, ' ')) FROM post_src
  UNION ALL
  SELECT id, 'artist', unnest(string_split(tag_string_artist, ' ')) FROM post_src
  UNION ALL
  SELECT id, 'copyright', unnest(string_split(tag_string_copyright, ' ')) FROM post_src
  UNION ALL
  SELECT id, 'meta', unnest(string_split(tag_string_meta, ' ')) FROM post_src)
WHERE name <> ''""",
    "tag": """
SELECT CAST(row_number() OVER (ORDER BY kind, name) - 1 AS BIGINT) AS tag_id, name, kind
FROM (SELECT DISTINCT kind, name FROM tok)""",
    "post": """
SELECT id, created_at, score, rating, file_url,
       CASE WHEN created_at = 'bad' THEN NULL
            ELSE CAST(CAST(created_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) END
         AS created_at_utc
FROM post_src""",
    "post_tag": "SELECT tok.id AS post_id, tag.tag_id FROM tok JOIN tag USING (kind, name)",
    "stats": """
SELECT t.kind, t.tag_id, t.name AS tag_name, min(p.created_at_utc) AS first_seen,
       count(*) AS post_count
FROM tag t JOIN post_tag pt ON t.tag_id = pt.tag_id JOIN post p ON p.id = pt.post_id
GROUP BY t.kind, t.tag_id, t.name""",
}

# What each expression builds on.
NEEDS = {
    "post_src": (),
    "tok": ("post_src",),
    "tag": ("tok",),
    "post": ("post_src",),
    "post_tag": ("tok", "tag"),
    "stats": ("tag", "post_tag", "post"),
}


def define(name: str, sql: str, *needs: str) -> None:
    """Add a common table expression for the SQL side."""
    CTES[name] = sql
    NEEDS[name] = needs


def with_expressions(sql: str, uses: tuple[str, ...], saved: frozenset[str] = frozenset()) -> str:
    """``sql`` behind the expressions it builds on, but for those that are saved tables."""

    def visit(names, done):
        for name in names:
            if name not in saved and name not in done:
                visit(NEEDS[name], done)
                done.append(name)
        return done

    parts = [f"{name} AS ({CTES[name]})" for name in visit(uses, [])]
    return ("WITH " + ", ".join(parts) + "\n" if parts else "") + sql


def query(name: str, sql: str | None = None, uses: tuple[str, ...] | str = ()) -> Callable[[Query], Query]:
    """Register a query. ``uses`` names the expressions ``sql`` builds on."""
    uses = (uses,) if isinstance(uses, str) else uses

    def register(run: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return run(spark, sf_dir)

        QUERIES[name] = configured
        if sql is not None:
            PARTS[name] = (sql.strip(), uses)
            ORACLES[name] = with_expressions(sql.strip(), uses)
        return run

    return register


def same_result(name: str, like: str) -> Callable[[Query], Query]:
    """Register a query whose result must equal that of ``like``."""

    def register(run: Query) -> Query:
        query(name, *PARTS[like])(run)
        return run

    return register


def clock(column: str | Column) -> Column:
    """Times leave the queries as text, which reads the same in every engine."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


CLOCK = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def fresh_folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A folder of its own for one run of a writing query."""
    return fixtures.folder(spark, sf_dir, f"runs/{name}-{uuid.uuid4().hex}")
