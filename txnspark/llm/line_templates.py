"""Line dedup by a log-template tree of fixed depth.

A line's form has its white space collapsed and every token with a digit replaced by ``<*>``. Forms
are parsed down a tree: first by their number of tokens, then by their first ``DEPTH`` tokens. A leaf
holds any number of templates. Each token after the first ``DEPTH`` is weighed by how many distinct forms of the
leaf have it at its place. A form's support is the weight that 3 of 5 of these places reach; places of
half the support or more are constant, the others variable fields. Forms with the same constant
tokens at the same places are one template; a form with a support of one is a template of its own. Since distinct
forms are weighed, copies of a line, however many, change nothing for the others.

A template that recurs in ``MIN_DOCS`` documents or more is dropped from all of them but the one
with the smallest doc_id, so that nothing vanishes from the corpus. A line of ``LONG_WORDS`` words or
more also recurs if ``LONG_DOCS`` documents have its form.

With ``spare_near_copies``, as in the pipeline, a document that as a whole is a near copy of the one with
the smallest id keeps long lines that recur in fewer than ``MIN_DOCS``, as near dedup takes it out whole.

Only DataFrame operations are used. Lines of leaves with too few lines leave after
one count; what travels beyond it are recurring lines, counted before each shuffle.

Defined results: blank lines are kept and not counted; a null text stays null; a text may become
empty, its row stays. Rows with one doc_id are one document; rows without doc_id are left alone and
do not count. Repeated lines of a document count once. A text or line of any length is read whole. An empty
table gives an empty one. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.session import written

DEPTH = 3
MIN_DOCS = 6
LONG_WORDS = 20
LONG_DOCS = 2
#: A near copy shares this part of its shingles of so many words.
SIMILARITY = 0.8
SHINGLE_WORDS = 5
#: Hashes of a document's dropped lines lie in so many lists, for quick look-up.
LISTS = 256


def forms_of(text: F.Column) -> F.Column:
    """The forms of all lines of a text."""
    single = F.regexp_replace(text, "[ \\t\\x0B-\\r]{2,}|[\\t\\x0B-\\r]", " ")
    masked = F.regexp_replace(single, "(?<![^ \\n])[^ \\n0-9]*+[0-9][^ \\n]*", "<*>")
    # most texts have neither digits nor other white space; a look for these, which is much cheaper
    # than a pattern, spares them both passes
    marks = [*"0123456789", "\t", "\x0b", "\x0c", "\r", "  "]
    plain = F.when(reduce(or_, (F.contains(text, F.lit(m)) for m in marks)), masked).otherwise(text)
    return F.transform(F.split(plain, "\n"), lambda line: F.trim(line))


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, form: the distinct forms of each document that are not blank."""
    forms = F.array_distinct(forms_of(F.col("text"))).alias("forms")
    texts = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", forms)
    # the outer form, as for the other Spark infers a filter that makes the forms once more
    lines = texts.select("doc_id", F.explode_outer("forms").alias("form"))
    size = F.length("form") - F.length(F.replace("form", F.lit(" "), F.lit(""))) + 1
    leaf = F.concat_ws(" ", size, F.substring_index("form", " ", DEPTH))
    return lines.filter("form <> ''").select("doc_id", leaf.alias("leaf"), "form")


def _templates(forms: DataFrame) -> DataFrame:
    """key, template: the template of every form (leaf, form, key) that shares one with other forms."""
    tokens = F.split("form", " ")
    later = F.when(F.size(tokens) > DEPTH, F.slice(tokens, DEPTH + 1, F.size(tokens)))
    places = forms.select("key", "leaf", F.posexplode(later).alias("at", "token"))
    places = places.select("key", F.unhex(F.md5(F.concat_ws(" ", "leaf", "at", "token"))).alias("place"))
    weights = places.groupBy("place").agg(F.count("*").alias("weight")).filter("weight > 1")
    weights = written(weights, "place-weights")
    # plain shuffles on both sides, so that places which many forms share can be split
    weighed = places.join(weights.hint("merge"), "place", "left").select(
        "key", F.struct(F.coalesce("weight", F.lit(1)).alias("weight"), "place").alias("mark")
    )
    marks = weighed.groupBy("key").agg(F.collect_list("mark").alias("marks"))
    heaviest = F.sort_array("marks.weight", asc=False)
    marks = marks.withColumn("support", F.get(heaviest, F.expr("int((3 * size(marks) + 4) div 5) - 1")))
    constant = F.filter("marks", lambda m: 2 * m["weight"] >= F.col("support"))
    names = F.array_sort(F.transform(constant, lambda m: F.hex(m["place"])))
    template = F.unhex(F.md5(F.array_join(names, " ")))
    return marks.filter("support > 1").select("key", template.alias("template"))


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, long_docs: int = LONG_DOCS) -> DataFrame:
    """doc_id, hash: the lines that a document loses, by the hash of their form."""
    lines = _lines(docs.select("doc_id", "text"))
    long = F.substring_index("leaf", " ", 1).cast("int") >= LONG_WORDS
    busy = lines.groupBy("leaf").agg(F.count("*").alias("lines"))
    busy = busy.filter(F.col("lines") >= F.when(long, min(min_docs, long_docs)).otherwise(min_docs))
    busy = written(busy, "busy-leaves")
    # merged at every size: busy leaves grow with the input
    recurring = lines.join(busy.hint("merge"), "leaf").withColumn("key", F.unhex(F.md5("form")))
    recurring = written(recurring, "recurring-lines", "zstd")
    forms = recurring.filter(F.col("lines") >= min_docs).select("leaf", "form", "key").distinct()
    templates = written(_templates(written(forms, "recurring-forms", "zstd")), "form-templates", "zstd")

    placed = recurring.join(templates.hint("merge"), "key", "left").select(
        "doc_id",
        F.xxhash64("form").alias("hash"),
        long.alias("long"),
        "key",
        F.coalesce("template", "key").alias("template"),
    )
    # a long line counts by its template and by its own form
    marks = F.when(F.col("long"), F.array_distinct(F.array("template", "key"))).otherwise(F.array("template"))
    placed = placed.select("doc_id", "hash", "long", "key", F.explode(marks).alias("mark"))
    needed = F.when(F.col("long") & (F.col("mark") == F.col("key")), min(min_docs, long_docs)).otherwise(min_docs)
    placed = written(placed.select("doc_id", "hash", "mark", needed.alias("needed")), "placed-lines", "zstd")
    common = (
        placed.select("mark", "needed", "doc_id")
        .distinct()
        .groupBy("mark", "needed")
        .agg(F.count("*").alias("docs"), F.min("doc_id").alias("first"))
        .filter("docs >= needed")
        .select("mark", "first")
    )
    common = written(common, "common-templates")
    return placed.join(common.hint("merge"), "mark").filter("doc_id <> first").select("doc_id", "hash")


def dropped_long_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, hash: long lines that a document loses as two documents or more, but under ``min_docs``, have them."""
    lines = _lines(docs.select("doc_id", "text"))
    words = F.substring_index("leaf", " ", 1).cast("int")
    lines = lines.filter(words >= LONG_WORDS).select("doc_id", F.xxhash64("form").alias("hash"))
    lines = written(lines, "long-lines", "zstd")
    common = lines.groupBy("hash").agg(F.count_distinct("doc_id").alias("docs"), F.min("doc_id").alias("first"))
    common = written(common.filter(F.col("docs").between(LONG_DOCS, min_docs - 1)), "common-long-lines")
    found = lines.join(common.hint("merge"), "hash").filter("doc_id <> first")
    found = written(found.select("doc_id", "hash", "first").distinct(), "long-lines-found")

    # texts are compared once, however many documents have them
    ids = docs.select("doc_id", F.xxhash64("text").alias("text_hash")).distinct()
    texts = found.select("doc_id", "first").distinct()
    for name, side in (("doc_id", "a"), ("first", "b")):
        own = ids.select(F.col("doc_id").alias(name), F.col("text_hash").alias(side))
        texts = texts.join(own.hint("merge"), name)
    texts = written(texts, "long-line-pairs")
    near = _near_copies(texts.select("a", "b").filter("a <> b").distinct(), docs).withColumn("near", F.lit(True))
    judged = texts.join(near.hint("merge"), ["a", "b"], "left")
    copies = judged.filter("near OR a = b").select("doc_id", "first").distinct()
    return found.join(copies.hint("merge"), ["doc_id", "first"], "left_anti").select("doc_id", "hash")


def _near_copies(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of text hashes whose texts share 0.8 of their five-word shingles."""
    ends = pairs.select(F.col("a").alias("text_hash")).union(pairs.select(F.col("b"))).distinct()
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text").dropDuplicates(["text_hash"])
    texts = texts.join(ends.hint("merge"), "text_hash")
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lower = F.translate("text", capitals, capitals.lower())
    words = F.filter(F.split(lower, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    # a shorter text is one shingle
    last = F.greatest(F.size("words") - SHINGLE_WORDS + 1, F.lit(1))
    shingle = lambda i: F.xxhash64(F.array_join(F.slice("words", i, SHINGLE_WORDS), " "))
    sets = texts.select("text_hash", words.alias("words"))
    sets = sets.select("text_hash", F.array_distinct(F.transform(F.sequence(F.lit(1), last), shingle)).alias("shingles"))
    sets = written(sets, "long-line-shingles")
    for side in "ab":
        own = sets.select(F.col("text_hash").alias(side), F.col("shingles").alias(f"{side}_set"))
        pairs = pairs.join(own.hint("merge"), side)
    common = F.size(F.array_intersect("a_set", "b_set"))
    whole = F.size("a_set") + F.size("b_set") - common
    return pairs.filter(common >= F.lit(SIMILARITY) * whole).select("a", "b")


def without_templates(
    docs: DataFrame, min_docs: int = MIN_DOCS, counts: bool = True, spare_near_copies: bool = False
) -> DataFrame:
    """``docs`` with the text that is left; with ``counts``, n_lines and n_dropped in front of it all."""
    dropped = dropped_lines(docs, min_docs, min_docs if spare_near_copies else LONG_DOCS)
    if spare_near_copies:
        dropped = dropped.unionByName(dropped_long_lines(docs, min_docs))
    lists = (
        dropped.groupBy("doc_id", F.pmod("hash", F.lit(LISTS)).alias("list"))
        .agg(F.collect_set("hash").alias("hashes"))
        .groupBy(F.col("doc_id").alias("_of"))
        .agg(F.map_from_entries(F.collect_list(F.struct("list", "hashes"))).alias("_drop"))
    )
    lists = written(lists, "lines-to-drop")
    names = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"))
    joined = rows.join(lists.hint("merge"), F.col("_row.doc_id") == F.col("_of"), "left")
    text = F.col("_row.text")
    forms = forms_of(text)
    gone = lambda i: F.array_contains(
        F.try_element_at("_drop", F.pmod(F.xxhash64(F.get("_forms", i)), F.lit(LISTS))),
        F.xxhash64(F.get("_forms", i)),
    )
    left = F.filter("_lines", lambda line, i: ~F.coalesce(gone(i), F.lit(False)))
    # forms are made anew only for documents that lose a line
    joined = joined.withColumns(
        {
            "_lines": F.split(text, "\n"),
            "_forms": F.when(F.col("_drop").isNotNull(), forms),
        }
    ).withColumn("_left", F.when(F.col("_drop").isNotNull(), left).otherwise(F.col("_lines")))
    kept = F.when(F.col("_drop").isNotNull(), F.array_join("_left", "\n")).otherwise(text)
    sizes = (
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_lines") - F.size("_left"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    rest = (kept.alias(c) if c == "text" else F.col(f"_row.`{c}`") for c in names)
    return joined.select(*(sizes if counts else ()), *rest)
