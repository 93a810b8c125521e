"""Table functions for SQL over views of the store: objectives of a project, nearest items, hybrid search.

They are SQL functions, which the planner inlines where they are called, so a lateral
join of many rows with one is a distributed join and nothing runs row by row in Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from quillspark.operators.search import RANK_CONSTANT, TEXT_WEIGHT, TOP, VECTOR_WEIGHT

_LIVE = "is_active AND NOT archived AND superseded_by IS NULL"
_SQUARES = "aggregate({0}, 0D, (s, x) -> s + CAST(x AS DOUBLE) * CAST(x AS DOUBLE))"
_DOT = "aggregate(zip_with({0}, {1}, (x, y) -> CAST(x AS DOUBLE) * CAST(y AS DOUBLE)), 0D, (s, x) -> s + x)"
_WORDS = "array_distinct(filter(split(lower({0}), '[^a-z0-9]+'), w -> w <> ''))"


def _cosine(a: str, b: str) -> str:
    return f"{_DOT.format(a, b)} / sqrt({_SQUARES.format(a)} * {_SQUARES.format(b)})"


def register_functions(spark: SparkSession, items: str = "memory_items", objectives: str = "memory_objectives") -> None:
    """Make ``objective_list``, ``match_memories`` and ``memory_hybrid_search`` callable in SQL, over the views of these names.

    ``objective_list(project)``: active objectives in order, those without a rank last.
    ``match_memories(vector, least, n, project)``: the ``n`` live items of a project that
    are nearest and reach ``least``; vectors of another length, zero ones and nulls match nothing.
    It is for a few rows: it compares pair by pair; ``search.matched_memories`` is the same for many.
    ``memory_hybrid_search(text, vector, n)``: live items by ranks of shared words and of
    vectors fused, words alone where the vector is null; ``n`` of them, five as a rule.
    """
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION objective_list(wanted STRING) RETURNS TABLE (id BIGINT, project STRING, rank INT, content STRING, place INT)
        RETURN SELECT id, project, rank, content, row_number() OVER (PARTITION BY project ORDER BY rank ASC NULLS LAST, content, id) FROM {objectives} WHERE status = 'active' AND project = objective_list.wanted""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION match_memories(vector ARRAY<DOUBLE>, least DOUBLE, n INT, wanted STRING) RETURNS TABLE (id BIGINT, similarity DOUBLE)
        RETURN SELECT id, similarity FROM (SELECT id, similarity, row_number() OVER (ORDER BY similarity DESC, id) AS k FROM
         (SELECT id, {_cosine("embedding", "match_memories.vector")} AS similarity FROM {items} WHERE {_LIVE} AND project = match_memories.wanted AND size(embedding) = size(match_memories.vector) AND {_SQUARES.format("embedding")} * {_SQUARES.format("match_memories.vector")} > 0)
         WHERE similarity >= match_memories.least) WHERE k <= match_memories.n""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION memory_hybrid_search(query STRING, vector ARRAY<DOUBLE>, n INT DEFAULT {TOP}) RETURNS TABLE (id BIGINT, similarity DOUBLE, place INT)
        RETURN SELECT id, similarity, place FROM (SELECT id, similarity, row_number() OVER (ORDER BY similarity DESC, id) AS place FROM
         (SELECT id, CASE WHEN shared > 0 THEN CASE WHEN memory_hybrid_search.vector IS NULL THEN 1D ELSE {TEXT_WEIGHT}D END / ({RANK_CONSTANT} + row_number() OVER (ORDER BY shared DESC, id)) ELSE 0D END
           + CASE WHEN near IS NOT NULL THEN {VECTOR_WEIGHT}D / ({RANK_CONSTANT} + row_number() OVER (ORDER BY near DESC NULLS LAST, id)) ELSE 0D END AS similarity FROM
          (SELECT id, size(array_intersect({_WORDS.format("content")}, {_WORDS.format("memory_hybrid_search.query")})) AS shared,
            CASE WHEN size(embedding) = size(memory_hybrid_search.vector) AND {_SQUARES.format("embedding")} > 0 THEN {_cosine("embedding", "memory_hybrid_search.vector")} END AS near FROM {items} WHERE {_LIVE}))
         WHERE similarity > 0) WHERE place <= memory_hybrid_search.n""")
