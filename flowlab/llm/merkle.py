"""Document fingerprints: a Merkle tree over sections, paragraphs and short word runs.

Blank lines end a section, line ends a paragraph; a paragraph's leaves are runs of up to five
words that do not cross a sentence's end. A node's digest is that of its children's digests;
the root also covers the whole text, so equal roots mean equal texts. The fingerprint string is
the whole tree, so two of them show which branches differ without the texts. SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.session import cut_lineage

#: Words of a leaf at most.
LEAF_WORDS = 5


def _cut(text: Column, after: str) -> Column:
    """Pieces of ``text``, cut behind each match of ``after``; nothing is lost."""
    return F.split(F.regexp_replace(text, f"({after})", "$1\u0001"), "\u0001", -1)


def tree(text: Column) -> Column:
    """array of sections of paragraphs of leaf digests (md5 in hex). Null counts as empty."""
    def leaves(paragraph):
        runs = F.transform(_cut(paragraph, "[.!?]+ +"), lambda s: _cut(s, f"(?:[^ ]+ +){{{LEAF_WORDS}}}"))
        return F.transform(F.filter(F.flatten(runs), lambda x: x != ""), F.md5)

    return F.transform(_cut(F.coalesce(text, F.lit("")), "\n{2,}"), lambda s: F.transform(_cut(s, "\n+"), leaves))


def fingerprint(text: Column, nodes: Column) -> Column:
    """root:section(paragraph[leaf.leaf],paragraph[...])/section(...); leaves and inner nodes as
    the first 8 and 16 digits of their digests, the root whole. ``nodes`` is :func:`tree`."""
    def digest(children):
        return F.md5(F.array_join(children, ""))

    def paragraph(leaves):
        return F.concat(F.substring(digest(leaves), 1, 16), F.lit("["), F.array_join(F.transform(leaves, lambda x: F.substring(x, 1, 8)), "."), F.lit("]"))

    def section(paragraphs):
        own = digest(F.transform(paragraphs, digest))
        return F.concat(F.substring(own, 1, 16), F.lit("("), F.array_join(F.transform(paragraphs, paragraph), ","), F.lit(")"))

    root = F.md5(F.concat(F.md5(F.coalesce(text, F.lit(""))), F.array_join(F.transform(nodes, lambda s: digest(F.transform(s, digest))), "")))
    return F.concat(root, F.lit(":"), F.array_join(F.transform(nodes, section), "/"))


def short_leaves(nodes: Column) -> Column:
    """The distinct leaves of a tree, each by the 8 digits its fingerprint shows."""
    return F.array_distinct(F.transform(F.flatten(F.flatten(nodes)), lambda x: F.substring(x, 1, 8)))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the share of leaves that two trees (their :func:`short_leaves`) have in common, of
    the larger tree's; two trees without leaves are alike."""
    larger = F.greatest(F.size(a), F.size(b))
    return F.when(larger == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / larger)


def differing_branches(a: Column, b: Column) -> Column:
    """(section, paragraph) positions, from 0, at which two fingerprint strings differ; descends
    only into sections whose digests differ."""
    def sections(fp):
        return F.split(F.substring_index(fp, ":", -1), "/", -1)

    def paragraphs(section):
        return F.split(F.regexp_extract(section, r"\((.*)\)", 1), ",", -1)

    def places(pair, i):
        pairs = F.arrays_zip(paragraphs(F.coalesce(pair["0"], F.lit("()"))).alias("x"), paragraphs(F.coalesce(pair["1"], F.lit("()"))).alias("y"))
        numbered = F.transform(pairs, lambda p, j: F.struct(i.alias("section"), j.alias("paragraph"), (~p["x"].eqNullSafe(p["y"])).alias("differs")))
        return F.when(pair["0"].eqNullSafe(pair["1"]), F.filter(numbered, lambda p: F.lit(False))).otherwise(F.filter(numbered, lambda p: p["differs"]))

    both = F.arrays_zip(sections(a), sections(b))
    return F.transform(F.flatten(F.transform(both, places)), lambda p: F.struct(p["section"], p["paragraph"]))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of every row. Null texts are empty texts; equal texts have equal
    fingerprints and no others. Repeated rows stay; other columns are not looked at."""
    t = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(docs[id_col].cast("long").alias("doc_id"), t.alias("t"), tree(t).alias("nodes")) \
        .select("doc_id", fingerprint(F.col("t"), F.col("nodes")).alias("fingerprint"))


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id) of distinct ids: the next smaller one; after the smallest, the largest. A
    null id is smaller than any. Ids are range-partitioned; only each range's first id meets in
    one task."""
    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    down = F.desc_nulls_last("doc_id")
    s = cut_lineage(ids.select("doc_id").distinct().repartitionByRange(n, down).withColumn("__range", F.spark_partition_id()))
    lead = F.lead(F.struct("doc_id")).over(Window.partitionBy("__range").orderBy(down))
    firsts = s.groupBy("__range").agg(F.max("doc_id").alias("first"))     # one row for each range
    order = Window.orderBy("__range")
    after = firsts.select(F.col("__range").alias("__r"), F.coalesce(
        F.lead(F.struct("first")).over(order),
        F.first(F.struct("first")).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    return s.withColumn("__lead", lead).join(after, F.col("__range") == F.col("__r")) \
        .select("doc_id", F.when(F.col("__lead").isNotNull(), F.col("__lead.doc_id")).otherwise(F.col("after.first")).alias("next_id"))


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, and where the tree of the edited text differs: branches_edited (the
    number of its paragraphs that do), first_section and first_paragraph (-1: none). The edited text ends with the beginning of the next document's (next
    smaller id; of rows that share an id, the text with the smallest md5 stands for it). Null
    texts are empty. Repeated rows stay; a single document follows itself; empty in, empty out.

    Texts are dealt by id once; a document then sends the one before it no more than the
    characters it needs and the leaves of its tree, four bytes each."""
    def key(i):                    # never null, so that grouping and joining by it share one shuffle
        return F.struct(i.isNull().alias("none"), F.coalesce(i, F.lit(0)).alias("id"))

    d = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("t")) \
        .select(key(F.col("doc_id")).alias("k"), "t")          # both joins below read this one shuffle
    lengths = d.groupBy(F.col("k").alias("l")).agg(F.max(F.char_length("t")).alias("l_chars"))
    follows = next_ids(docs.select(docs[id_col].cast("long").alias("doc_id"))).select(key(F.col("doc_id")).alias("f"), key(F.col("next_id")).alias("x")) \
        .join(lengths, F.col("f") == F.col("l")).select("f", "x", "l_chars")
    sent = d.join(follows, F.col("k") == F.col("x")).select("f", F.struct(
        F.md5("t").alias("h"), F.substring("t", F.lit(1), F.floor(F.col("l_chars") / 2).cast("int")).alias("head"),
        F.unhex(F.array_join(short_leaves(tree(F.col("t"))), "")).alias("leaves")).alias("n"))
    one = sent.groupBy("f").agg(F.min("n").alias("n"))
    half = F.floor(F.char_length("t") / 2).cast("int")
    e = d.join(one, F.col("k") == F.col("f")).select(
        F.when(~F.col("k.none"), F.col("k.id")).alias("doc_id"), "t", F.char_length("t").cast("long").alias("n_chars"),
        F.concat(F.substring("t", F.lit(1), F.char_length("t") - half), F.substring("n.head", F.lit(1), half)).alias("e"),
        F.regexp_extract_all(F.lower(F.hex("n.leaves")), F.lit(".{8}"), F.lit(0)).alias("c"))
    trees = e.select("*", tree(F.col("t")).alias("a"), tree(F.col("e")).alias("b"))
    near = trees.select("*", short_leaves(F.col("a")).alias("la"), short_leaves(F.col("b")).alias("lb"),
                        fingerprint(F.col("t"), F.col("a")).alias("fingerprint"), fingerprint(F.col("e"), F.col("b")).alias("edited_fingerprint"))
    # equal roots end the comparison, else it descends into the sections that differ
    same = F.col("fingerprint") == F.col("edited_fingerprint")
    found = near.select("*", F.when(~same, differing_branches(F.col("fingerprint"), F.col("edited_fingerprint"))).alias("branches"))
    first = F.get("branches", F.lit(0))
    return found.select("doc_id", "n_chars", F.sha2("e", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                        likeness(F.col("la"), F.col("lb")).alias("near_edited"), likeness(F.col("la"), F.col("c")).alias("near_next"),
                        F.coalesce(F.size("branches"), F.lit(0)).alias("branches_edited"),
                        F.coalesce(first["section"], F.lit(-1)).alias("first_section"), F.coalesce(first["paragraph"], F.lit(-1)).alias("first_paragraph"))
