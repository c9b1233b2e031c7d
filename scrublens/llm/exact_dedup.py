"""Exact duplicates by deterministic block naming.

Texts, without their white space, are cut into blocks of ``BLOCK`` bytes. The different
blocks are sorted and numbered, and every block is replaced by its number, its name. Then
adjacent names are paired, the different pairs sorted and named in turn, and so on until
one name is left of each document: ``(level, name)``. Equal names on a level stand for
equal pairs of names below and so, in the end, for equal bytes; no digest is involved and
nothing can collide. A row of n blocks is done after log2(n) levels, and the rows halve
from level to level.

A block or pair that a third of all rows share is one row of the table of names, found by
an aggregate that combines before its shuffle; its name reaches the rows by a join, whose
crowded partitions Spark splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrublens.functions.charclass import bind
from scrublens.llm.common import keep_rows, row_key, written

BLOCK = 4096

#: The white space that does not count, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without white space; empty for null."""
    value = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        value = F.replace(value, F.lit(blank), F.lit(""))
    return value


def named(items: DataFrame, *key: str) -> DataFrame:
    """The different values of ``key`` with a ``name``, a whole number each: its place
    among the sorted values of its partition, counted on from the partition's first number.

    Sorting makes a partition that is computed again give the same names, and the table is
    written before it is used.
    """
    different = items.select(*key).distinct().sortWithinPartitions(*key)
    return written(different.withColumn("name", F.monotonically_increasing_id()))


def cut_blocks(data: Column, block: int) -> Column:
    """The bytes of a binary column in blocks of ``block`` bytes, the last one shorter; at
    least one, which may be empty."""
    many = F.greatest(F.ceil(F.octet_length(data) / F.lit(block)).cast("int"), F.lit(1))
    return F.transform(
        F.sequence(F.lit(0), many - 1), lambda i: F.substring(data, i * block + 1, F.lit(block))
    )


def block_names(rows: DataFrame) -> DataFrame:
    """The identity of each ``id, mark`` of ``rows``, a table with ``many``, ``at`` and
    ``name`` for every block, written: ``id, mark, level, name``. Equal identities mean
    equal sequences of names. Rows given twice agree and count once."""
    here = rows.select("id", "mark", "many", "at", "name", F.lit(0).alias("level"))
    done = []
    level = 0
    while True:
        done.append(here.filter("many = 1").select("id", "mark", "level", "name").distinct())
        going = here.filter("many > 1")
        if going.isEmpty():
            break
        level += 1
        even = F.col("at") % 2 == 0
        # max picks the only value there is; rows given twice agree.
        pairs = (
            going.groupBy("id", "mark", "many", F.floor(F.col("at") / 2).cast("int").alias("at"))
            .agg(F.max(F.when(even, F.col("name"))).alias("left"), F.max(F.when(~even, F.col("name"))).alias("right"))
            .withColumn("right", F.coalesce("right", F.lit(-1)))
        )
        pairs = written(pairs)
        names = named(pairs, "left", "right")
        here = written(
            pairs.join(names, ["left", "right"]).select(
                "id",
                "mark",
                F.ceil(F.col("many") / 2).cast("int").alias("many"),
                "at",
                "name",
                F.lit(level).alias("level"),
            )
        )
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole


def exact_duplicates(
    docs: DataFrame, id_col: str, text_col: str, block: int = BLOCK
) -> DataFrame:
    """One row for each row of ``docs``: the id, ``keep_id`` (of the row of its group that
    stays), ``group_size``, ``kept`` and ``text_sha256`` of the text without white space.

    Texts are equal if they are so without white space; null counts as empty. Of a group
    the row with most code points in its original text stays, then the one with the
    smallest id (null before all others). Rows that agree in id and length and belong to
    one group cannot be told apart and are reported alike. An empty table gives no row;
    other columns are not looked at.
    """
    # The binding makes Spark normalise a text once, not for every block.
    made = bind(
        normalised(F.col(text_col)).cast("binary"),
        lambda data: F.struct(
            F.sha2(data, 256).alias("mark"), cut_blocks(data, block).alias("blocks")
        ),
    )
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("length"),
        made.alias("made"),
    )
    blocks = rows.select(
        "id",
        "length",
        F.col("made.mark").alias("mark"),
        F.size("made.blocks").alias("many"),
        F.posexplode("made.blocks").alias("at", "block"),
    )
    names = named(blocks, "block")
    first = written(
        blocks.join(names, "block").select("id", "length", "mark", "many", "at", "name")
    )
    identity = written(block_names(first))
    lines = first.filter("at = 0").select("id", "mark", "length")
    same = (F.col("l.id").eqNullSafe(F.col("n.id"))) & (F.col("l.mark") == F.col("n.mark"))
    known = lines.alias("l").join(identity.alias("n"), same).select(
        "l.id", "l.mark", "l.length", "n.level", "n.name"
    )
    best = known.groupBy("level", "name").agg(
        F.min(F.struct((-F.col("length")).alias("shortness"), F.col("id"))).alias("best"),
        F.count(F.lit(1)).alias("group_size"),
    )
    found = known.join(best, ["level", "name"])
    is_best = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("length") == -F.col("best.shortness"))
    return found.select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        F.col("group_size"),
        is_best.alias("kept"),
        F.col("mark").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group. Rows are
    told apart by id and text, so null or repeated ids with other texts stay."""
    keyed = docs.withColumn("_row", row_key(id_col, text_col))
    kept = exact_duplicates(keyed, "_row", text_col).filter("kept").select("_row").distinct()
    return keep_rows(keyed, kept, "_row", "left_semi").dropDuplicates(["_row"]).drop("_row")
