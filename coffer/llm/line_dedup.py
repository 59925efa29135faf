"""Deletes later copies of repeated line runs, by prefix doubling over line-ID sequences. DataFrame functions only.

A document is the sequence of its lines that hold a word; a line's ID is a 128-bit fingerprint of the trimmed line. The
suffix that starts at a line gets a name for its first 1, 2, 4, ... lines: the name for 2n lines is made of the names for
n lines at the line and n lines further on, so a doubling step is a ``lead`` within the document. Suffixes of equal name
are one bucket of the suffix array, an interval of suffixes with that common prefix. Two overlapping blocks of a power of
two name a run of any length.

A run matters if it has ``min_words`` words. The interval test is made at the shortest run from each line, and up to each
line, that is so long: suffixes that share it are grouped over the whole corpus, and all but the first occurrence, by
document id and line, are later copies. Every longer repeated run is the union of such shortest ones, so joined together
they are the maximal repeated runs. The first occurrence of a line is never deleted.

Grouping combines before it shuffles, and only runs found at least twice are joined back, by an equi join that adaptive
execution may split: a line that a third of all documents hold costs no task more than its share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coffer.llm.common import documents, text_of

#: Words of the shortest run whose copies are deleted.
MIN_WORDS = 50
SPACE = " \t\x0b\x0c\r"
KEY = ("doc_id", "tag")


def _key(docs: DataFrame) -> DataFrame:
    """Id and text of every row, with a tag that parts rows of one id by their text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("tag"), text_of().alias("text")
    )


def line_sequences(docs: DataFrame) -> DataFrame:
    """Lines with a word: key, line number in the text, words, and the two halves of the line ID.

    Rows that repeat id and text are one document.
    """
    line = F.btrim("line", F.lit(SPACE))
    lines = (
        _key(docs).select(*KEY, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        .select(*KEY, "line_no", F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
                F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))
        .where("words > 0")
    )
    return lines.repartition(*KEY).groupBy(*KEY, "line_no").agg(*[F.max(c).alias(c) for c in ("words", "a", "b")])


def _levels(longest: int) -> int:
    return max(1, longest.bit_length())


def _block(level: Column, first: str, last: str, offset: int) -> Column:
    """Half of the name of a run: its first and its last block of ``2 ** level`` lines."""
    return F.xxhash64(F.lit(offset), F.element_at(F.col(first), level + offset), F.element_at(F.col(last), level + offset))


def shortest_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """The shortest runs of at least ``min_words`` words from and up to each line: key, name, first and last line."""
    in_doc = Window.partitionBy(*KEY)
    # words before the line and up to its end; both rise with the line number, as each line has a word
    upto = F.sum("words").over(in_doc.orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = lines.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("words"))
    order = in_doc.orderBy("before")
    levels = _levels(min_words)  # a run of min_words words has at most so many lines
    rows = rows.withColumnRenamed("a", "a0").withColumnRenamed("b", "b0")
    for k in range(1, levels):
        for half in "ab":
            name, step = F.col(f"{half}{k - 1}"), 1 << (k - 1)
            rows = rows.withColumn(f"{half}{k}", F.xxhash64(F.lit(half), name, F.lead(name, step).over(order)))
    names = [f"{half}{k}" for half in "ab" for k in range(levels)]
    ending = [F.lag(f"{half}{k}", (1 << k) - 1).over(order) for half in "ab" for k in range(levels)]
    rows = rows.select(*KEY, "line_no", "before", "upto", F.array(*names).alias("starting"), F.array(*ending).alias("ending"))
    ahead = order.rangeBetween(0, min_words - 1)
    behind = in_doc.orderBy("upto").rangeBetween(-(min_words - 1), 0)
    rows = rows.select(
        "*",
        F.count("*").over(ahead).alias("n_ahead"), F.last("ending").over(ahead).alias("ending_ahead"),
        F.last("line_no").over(ahead).alias("line_ahead"), F.last("upto").over(ahead).alias("upto_ahead"),
        F.count("*").over(behind).alias("n_behind"), F.first("starting").over(behind).alias("starting_behind"),
        F.first("line_no").over(behind).alias("line_behind"), F.first("before").over(behind).alias("before_behind"),
        F.lag("upto").over(order).alias("upto_last"),
    )

    def run(first_line: str, last_line: str, n: str, first: str, last: str, valid: Column) -> Column:
        level = F.floor(F.log2(n)).cast("int") + 1
        return F.when(valid, F.struct(
            F.col(first_line).alias("first_line"), F.col(last_line).alias("last_line"), F.col(n).alias("n_lines"),
            _block(level, first, last, 0).alias("a"), _block(level, first, last, levels).alias("b"),
        ))

    from_line = run("line_no", "line_ahead", "n_ahead", "starting", "ending_ahead",
                    F.col("upto_ahead") - F.col("before") >= min_words)
    # left out where the run without its last line is too short: then it is also the shortest from its first line
    to_line = run("line_behind", "line_no", "n_behind", "starting_behind", "ending",
                  F.coalesce(F.col("upto_last"), F.lit(0)) - F.col("before_behind") >= min_words)
    return rows.select(*KEY, F.explode(F.array_compact(F.array(from_line, to_line))).alias("r")).select(*KEY, "r.*")


def _place() -> Column:
    """Order of occurrences: by id, unknown ids last, then by line."""
    return F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "tag", "first_line")


def later_copies(runs: DataFrame) -> DataFrame:
    """Runs that occurred before, in an earlier document or an earlier line."""
    name = ["n_lines", "a", "b"]
    intervals = runs.groupBy(*name).agg(F.count("*").alias("n"), F.min(_place()).alias("origin")).where("n > 1")
    return runs.join(intervals, name).where(_place() > F.col("origin")).select(*KEY, "first_line", "last_line")


def delete_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later copies of repeated runs taken out of ``text``, and ``deleted_lines`` (their numbers).

    Blank lines between deleted lines go too; all other lines stay as they are. A text that is a later copy as a whole
    becomes empty. Null texts stay null, and null and empty texts have nothing to delete. Unknown ids count as later than
    all others. Rows that repeat id and text get one result; an empty table gives none. Other columns are kept; a column
    named ``deleted_lines`` is replaced.
    """
    found = later_copies(shortest_runs(line_sequences(docs), min_words))
    deleted = (
        found.select(*KEY, F.explode(F.sequence("first_line", "last_line")).alias("line"))
        .groupBy(*KEY).agg(F.sort_array(F.collect_set("line")).alias("lines"))
        .select(F.col("doc_id").alias("_ld_id"), F.col("tag").alias("_ld_tag"), F.col("lines").alias("_ld_lines"))
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_ld_id")) & (F.xxhash64(text_of()) == F.col("_ld_tag"))
    joined = docs.join(deleted, same, "left")
    lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_ld_lines"))
    text = F.when(F.col("_ld_lines").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    )
    gone = F.coalesce("_ld_lines", F.array().cast("array<int>"))
    return joined.withColumns({"deleted_lines": gone, "text": text}).select(
        *[c for c in docs.columns if c != "deleted_lines"], "deleted_lines"
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` after ``delete_repeats``, same columns, without the rows of which no word is left."""
    found = delete_repeats(docs)
    emptied = (F.size("deleted_lines") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return found.where(~emptied).select(*docs.columns)


def maximal_runs(lines: Column) -> Column:
    """Deleted line numbers as runs: an array of (first line, number of lines)."""
    starts = F.filter(lines, lambda x: ~F.array_contains(lines, x - 1))
    ends = F.filter(lines, lambda x: ~F.array_contains(lines, x + 1))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first_line"), (b - a + 1).alias("n_lines")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of 50 words or more that an earlier place has."""
    found = delete_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "text", F.size("deleted_lines").alias("n_deleted_lines"))


SQL = {
    "op7_line_dedup": r"""
        WITH split_lines AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
        worded AS (
            SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
                   trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS id
            FROM split_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
        placed AS (
            SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY line_no) AS upto,
                   sum(words) OVER (PARTITION BY doc_id ORDER BY line_no) - words AS before FROM worded),
        frames AS (
            SELECT doc_id, line_no, before, upto,
                   list(id) OVER ahead AS ids_a, last(line_no) OVER ahead AS last_a, last(upto) OVER ahead - before AS words_a,
                   list(id) OVER behind AS ids_b, first(line_no) OVER behind AS first_b, upto - first(before) OVER behind AS words_b
            FROM placed
            WINDOW ahead AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING),
                   behind AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
        runs AS (
            SELECT doc_id, line_no AS first_line, last_a AS last_line, ids_a AS ids FROM frames WHERE words_a >= 50
            UNION
            SELECT doc_id, first_b, line_no, ids_b FROM frames WHERE words_b >= 50),
        later AS (
            SELECT *, row_number() OVER (PARTITION BY ids ORDER BY doc_id, first_line) AS n FROM runs),
        gone AS (
            SELECT DISTINCT doc_id, unnest(generate_series(first_line, last_line)) AS line_no FROM later WHERE n > 1),
        per_doc AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
        rest AS (
            SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS text
            FROM split_lines ANTI JOIN gone USING (doc_id, line_no) GROUP BY doc_id)
        SELECT d.doc_id, CASE WHEN p.n IS NULL THEN d.text ELSE coalesce(r.text, '') END AS text,
               CAST(coalesce(p.n, 0) AS INTEGER) AS n_deleted_lines
        FROM documents d LEFT JOIN per_doc p USING (doc_id) LEFT JOIN rest r USING (doc_id)
    """,
}
