"""Counts over the texts, bracket audit, prime factors and square sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import corpus as ops
from millrace.operators.audit import bracket_audit
from millrace.operators.numbers import (
    factor_histogram,
    square_sum,
    with_factors,
    with_square_sum,
)
from millrace.plans.tidy import LINES
from millrace.session import fresh_path
from millrace.sources.tables import table
from millrace.sources.text import first_lines_of_files, numbered_lines, read_lines, write_lines

TOKEN = "the"


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def line_count(spark: SparkSession, folder: str) -> DataFrame:
    return ops.line_count(_documents(spark, folder), "text", ["lang"])


def char_count(spark: SparkSession, folder: str) -> DataFrame:
    return ops.char_count(_documents(spark, folder), "text", ["lang"])


def text_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return ops.text_sizes(_documents(spark, folder), "text", ["source"])


def token_hits(spark: SparkSession, folder: str) -> DataFrame:
    return ops.token_hits(_documents(spark, folder), "text", TOKEN, ["lang"])


def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return ops.word_count(_documents(spark, folder), "text")


def word_sum(spark: SparkSession, folder: str) -> DataFrame:
    return ops.word_sum(table(spark, folder, "conversations"), "text")


def plain_word_count(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the benchmark texts without the empty ones."""
    return ops.word_count(table(spark, folder, "benchmark"), "text", drop_empty=True)


def file_word_count(spark: SparkSession, folder: str) -> DataFrame:
    """Word count over text files, read by a glob."""
    path = fresh_path(spark, "conversation-text")
    write_lines(table(spark, folder, "conversations"), "text", path)
    return ops.word_count(read_lines(spark, f"{path}/*.txt"), "value")


def first_lines(spark: SparkSession, folder: str) -> DataFrame:
    return ops.first_lines(_documents(spark, folder), "text", "doc_id")


def _customer_files(spark: SparkSession, folder: str) -> str:
    """Customers as text, a folder with a file for each nation, lines by key."""
    path = fresh_path(spark, "customer-text")
    line = F.concat_ws(" ", "c_custkey", "c_name").alias("value")
    customers = table(spark, folder, "customer").repartition("c_nationkey")
    lines = customers.sortWithinPartitions("c_nationkey", "c_custkey").select("c_nationkey", line)
    lines.write.partitionBy("c_nationkey").text(path)
    return f"{path}/*/*.txt"


def file_line_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of many files with their number in the file and over all of them."""
    lines = numbered_lines(spark, _customer_files(spark, folder))
    return lines.select("line_no", "number", "value")


def first_file_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = first_lines_of_files(spark, _customer_files(spark, folder), 100)
    return lines.select("number", "value")


def brackets(spark: SparkSession, folder: str) -> DataFrame:
    return bracket_audit(_documents(spark, folder), "text", ["lang", "source"])


def page_brackets(spark: SparkSession, folder: str) -> DataFrame:
    """The audit over raw pages, whose scripts are full of brackets."""
    return bracket_audit(table(spark, folder, "pages"), "html", [])


def part_factors(spark: SparkSession, folder: str) -> DataFrame:
    parts = with_factors(table(spark, folder, "part").select("p_partkey", "p_size"), "p_size")
    return parts.withColumn("factors", F.array_join("factors", ","))


def order_factors(spark: SparkSession, folder: str) -> DataFrame:
    """Primes in the customer numbers of all orders."""
    return factor_histogram(table(spark, folder, "orders"), "o_custkey")


def line_squares(spark: SparkSession, folder: str) -> DataFrame:
    return square_sum(table(spark, folder, "lineitem"), "l_linenumber", ["l_returnflag"])


def vector_squares(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_square_sum(table(spark, folder, "embeddings"), "embedding")
    return rows.select("vec_id", F.round("square_sum", 6).alias("square_sum"))


def _words(line: str) -> str:
    return f"""
CASE WHEN {line} = '' THEN [''] WHEN rtrim({line}, ' ') = '' THEN []
     ELSE string_split(rtrim({line}, ' '), ' ') END
"""


def _word_rows(name: str, keep: str = "") -> str:
    return f"""
SELECT {keep} unnest({_words("line")}) AS word
FROM (SELECT {keep} unnest({LINES}) AS line FROM {name})
"""


def _count_sql(name: str) -> str:
    return f"SELECT word, count(*) AS n FROM ({_word_rows(name)}) GROUP BY 1"


LINE_COUNT = f"""
SELECT lang, CAST(sum(len({LINES})) AS BIGINT) AS lines FROM documents GROUP BY 1
"""

CHARS = r"""
CAST(coalesce(sum(length(regexp_replace(text, '[ \r\n]', '', 'g'))
       + length(regexp_replace(text, '[^\x{10000}-\x{10FFFF}]', '', 'g'))), 0) AS BIGINT)
"""

CHAR_COUNT = f"SELECT lang, {CHARS} AS chars FROM documents GROUP BY 1"

TEXT_SIZES = f"""
SELECT source, count(*) AS texts, CAST(sum(len(text_lines)) AS BIGINT) AS lines,
       CAST(sum(list_sum(list_transform(text_lines, lambda l: len({_words("l")}))))
            AS BIGINT) AS words,
       {CHARS} AS chars
FROM (SELECT source, text, {LINES} AS text_lines FROM documents) GROUP BY 1
"""

TOKEN_HITS = f"""
SELECT lang, count(*) FILTER (WHERE word = '{TOKEN}') AS hits
FROM ({_word_rows("documents", "lang,")}) GROUP BY 1
"""

PLAIN_WORDS = f"""
SELECT word, count(*) AS n FROM ({_word_rows("benchmark")}) WHERE word <> '' GROUP BY 1
"""

FILE_WORDS = rf"""
SELECT word, count(*) AS n FROM (
  SELECT unnest({_words("line")}) AS word
  FROM (SELECT unnest(regexp_split_to_array(text, '\r\n|\n|\r')) AS line FROM conversations)
) GROUP BY 1
"""

FIRST_LINES = f"""
SELECT doc_id, CAST(line_no - 1 AS INTEGER) AS line_no, line FROM (
  SELECT doc_id, unnest({LINES}) AS line, generate_subscripts({LINES}, 1) AS line_no
  FROM documents
) ORDER BY doc_id, line_no LIMIT 10
"""


def _bracket_sql(name: str, key: str, text: str, by: str) -> str:
    grouping = f"{by}," if by else ""
    return f"""
WITH chars AS (
  SELECT {key}, unnest(string_split(b, '')) AS c, generate_subscripts(string_split(b, ''), 1) AS i
  FROM (SELECT {key}, regexp_replace({text}, '[^()]', '', 'g') AS b FROM {name}) WHERE b <> ''
), depth AS (
  SELECT {key}, i, sum(CASE c WHEN '(' THEN 1 ELSE -1 END)
         OVER (PARTITION BY {key} ORDER BY i) AS d
  FROM chars
), verdict AS (
  SELECT {key}, min(d) >= 0 AND arg_max(d, i) = 0 AS ok FROM depth GROUP BY 1
)
SELECT {grouping} count(*) FILTER (WHERE {text} IS NOT NULL AND coalesce(ok, true)) AS balanced,
       count(*) FILTER (WHERE NOT coalesce(ok, true)) AS unbalanced,
       count(*) FILTER (WHERE {text} IS NULL) AS missing
FROM {name} LEFT JOIN verdict USING ({key}) {"GROUP BY " + by if by else ""}
"""


# Divisors p of n that are prime, once for every power of p that divides n.
FACTORS = """
WITH RECURSIVE numbers AS (
  SELECT CAST({value} AS BIGINT) AS n, count(*) AS copies FROM {name} GROUP BY 1
), steps AS (
  SELECT n, copies, n AS rest, CAST(2 AS BIGINT) AS p, CAST(NULL AS BIGINT) AS factor
  FROM numbers WHERE n > 1
  UNION ALL
  SELECT n, copies,
         CASE WHEN rest % p = 0 THEN rest // p WHEN p * p > rest THEN 1 ELSE rest END,
         CASE WHEN rest % p = 0 THEN p ELSE p + 1 END,
         CASE WHEN rest % p = 0 THEN p WHEN p * p > rest THEN rest END
  FROM steps WHERE rest > 1
)
"""

HISTOGRAM = FACTORS.format(value="o_custkey", name="orders") + """
SELECT factor, CAST(sum(copies) AS BIGINT) AS n
FROM steps WHERE factor IS NOT NULL GROUP BY 1
"""

PART_FACTORS = FACTORS.format(value="p_size", name="part") + """
SELECT p_partkey, p_size, coalesce(f, '') AS factors
FROM part LEFT JOIN (
  SELECT n, string_agg(CAST(factor AS VARCHAR), ',' ORDER BY factor) AS f
  FROM steps WHERE factor IS NOT NULL GROUP BY 1
) ON p_size = n
"""

LINE_SQUARES = """
SELECT l_returnflag, CAST(sum(l_linenumber * l_linenumber) AS BIGINT) AS square_sum
FROM lineitem GROUP BY 1
"""

VECTOR_SQUARES = """
SELECT vec_id, round(list_sum(list_transform(
         embedding, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE))), 6) AS square_sum
FROM embeddings
"""

# Files go by their paths, which hold the nation as text.
FILE_LINES = """
SELECT row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS line_no,
       row_number() OVER (ORDER BY CAST(c_nationkey AS VARCHAR), c_custkey) - 1 AS number,
       CAST(c_custkey AS VARCHAR) || ' ' || c_name AS value
FROM customer
"""
FIRST_FILE_LINES = f"SELECT number, value FROM ({FILE_LINES}) WHERE number < 100"

QUERIES = {
    "line_count": (line_count, LINE_COUNT),
    "char_count": (char_count, CHAR_COUNT),
    "text_sizes": (text_sizes, TEXT_SIZES),
    "token_hits": (token_hits, TOKEN_HITS),
    "word_count": (word_count, _count_sql("documents")),
    "word_count_summed": (word_sum, _count_sql("conversations")),
    "word_count_plain": (plain_word_count, PLAIN_WORDS),
    "word_count_files": (file_word_count, FILE_WORDS),
    "file_line_numbers": (file_line_numbers, FILE_LINES),
    "first_file_lines": (first_file_lines, FIRST_FILE_LINES),
    "first_lines": (first_lines, FIRST_LINES),
    "bracket_audit": (brackets, _bracket_sql("documents", "doc_id", "text", "lang, source")),
    "bracket_audit_pages": (page_brackets, _bracket_sql("pages", "page_id", "html", "")),
    "part_factors": (part_factors, PART_FACTORS),
    "factor_histogram": (order_factors, HISTOGRAM),
    "squares_sum": (line_squares, LINE_SQUARES),
    "vector_squares": (vector_squares, VECTOR_SQUARES),
}
