"""Exact duplicates by deterministic block naming.

Texts are normalised (each run of ASCII white space becomes one space) and cut into blocks of a
fixed size. Distinct blocks are sorted and numbered; adjacent numbers of a document are paired,
distinct pairs are sorted and numbered again, until one number is left. Equal sequences get equal
numbers and different ones never do: no hash decides.

The first name is that of (length, leading block). A document that shares it with no other has its
identity already and leaves the recursion, so only the blocks of possible copies travel.

Defined results: a null text counts as empty; empty texts are copies of each other. Every input row
counts as a document, rows that repeat a ``doc_id`` too: of equal rows the one with the smallest
``doc_id`` stays, null ids last, ties by row. Other columns are not looked at. An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.session import written

HEAD_CHARS = 256
BLOCK_CHARS = 4096


def normalised(text: F.Column) -> F.Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t-\\r]+", " ")


def named(values: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct ``columns`` with an integer ``name``: partition and rank in its sorted order.

    Equal values meet in one partition, so no sample of the values is needed to range them. The
    names are written, so that they are the same for all that read them.
    """
    in_order = values.select(*columns).distinct().sortWithinPartitions(*columns)
    return written(in_order.withColumn("name", F.monotonically_increasing_id()), "block-names", "zstd")


def _identities(prepared: DataFrame, head_chars: int, block_chars: int) -> DataFrame:
    """``row``, ``head``, ``name`` of the rows that share length and leading block with another."""
    head = F.substring("text", 1, head_chars).alias("block")
    heads = prepared.select("row", "n_chars", head)
    shared = heads.groupBy("n_chars", "block").count().filter("count > 1")
    names = named(shared, ["n_chars", "block"]).withColumnRenamed("name", "head")
    rows = heads.join(names, ["n_chars", "block"]).select("row", "n_chars", "head")
    rows = written(rows, "shared-heads")

    whole = rows.filter(F.col("n_chars") <= head_chars).select(
        "row", "head", F.lit(-1).cast("long").alias("name")
    )
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    blocks = (
        prepared.filter(F.col("n_chars") > head_chars)
        .select("row", "text")
        # merged at every size: what is shared grows with the input
        .join(rows.select("row", "head").hint("merge"), "row")
        .select("row", "head", F.posexplode(pieces).alias("at", "block"))
    )
    blocks = written(blocks, "blocks", "zstd")
    left = blocks.join(named(blocks, ["block"]), "block").select("row", "head", "at", "name")
    left = written(left, "named-blocks")
    done = [whole]
    while True:
        # a document of one block has its identity; equal texts have equally many blocks
        size = left.groupBy("row").agg(F.count("*").alias("_blocks"))
        longest = size.agg(F.max("_blocks")).first()[0] or 0
        if longest <= 1:
            done.append(left.select("row", "head", "name"))
            break
        pair = left.groupBy("row", "head", F.shiftright("at", 1).alias("_half")).agg(
            F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("first"),
            F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(-1)).alias("second"),
        )
        pair = written(pair.withColumnRenamed("_half", "at"), "block-pairs")
        left = written(
            pair.join(named(pair, ["first", "second"]), ["first", "second"]).select(
                "row", "head", "at", "name"
            ),
            "named-pairs",
        )
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def exact_groups(
    docs: DataFrame, head_chars: int = HEAD_CHARS, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    text = normalised(F.col("text"))
    prepared = written(
        docs.select("doc_id", text.alias("text"), F.monotonically_increasing_id().alias("row")).select(
            "doc_id",
            "row",
            "text",
            F.length("text").alias("n_chars"),
            F.sha2("text", 256).alias("text_sha256"),
        ),
        "normalised-texts",
        "zstd",
    )
    ids = _identities(prepared, head_chars, block_chars)
    ids = ids.join(prepared.select("row", "doc_id"), "row")
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id"), F.col("row")))
    groups = ids.groupBy("head", "name").agg(first.alias("first"), F.count("*").alias("group_size"))
    # written, so that the join below is between plain shuffles, which large groups can be split in
    groups = written(groups, "copy-groups")
    copies = ids.join(groups, ["head", "name"]).select(
        "row",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
    )
    return prepared.select("doc_id", "row", "text_sha256").join(copies, "row", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce("kept", F.lit(True)).alias("kept"),
        "text_sha256",
    )
