"""Fingerprints of documents as the roots of Merkle trees over sections, paragraphs and phrases.

A paragraph is a line; its node is the SHA-256 of the line. A section is a run of paragraphs that ends with an empty
line or with a paragraph whose node begins with 0 or 8, an eighth of them: the text itself says where a section ends,
so an edit moves no border but its own. A section's node is the SHA-256 of its paragraphs' nodes, the root that of the
sections' nodes. Equal roots mean equal texts. Where roots differ, sections whose node the other tree lacks lead to the
paragraphs that were edited; nothing below a shared branch is looked at.

Below the paragraphs lie phrases, the finest leaves: runs of characters up to a line end or up to a space after any
character that is not one of PLAIN. They let texts of few lines be alike in part. The likeness of two trees is the
share of distinct nodes, of all levels, that they have in common (Dice); it is 1 only where the roots are equal.

NULL text counts as empty, and an empty text is one empty paragraph. Very long texts cost time in proportion. Repeated
rows are fingerprinted each; repeated paragraphs of a text count once in its likeness. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.operators.ordered import find_cuts, with_previous

#: Letters after which a space does not end a phrase; phrases come to a few words in most languages.
PLAIN = "a-gi-np-su-y"
#: Text in one window task when neighbours in id order are looked up.
CHUNK_BYTES = 8 << 20


def sections_of(paragraphs: Column) -> Column:
    """Runs of paragraph nodes, each run as one text."""
    empty = F.sha2(F.lit(""), 256)
    ends = lambda x: F.substring(x, 1, 1).isin("0", "8") | (x == empty)
    closed = F.transform(paragraphs, lambda x: F.concat(x, F.when(ends(x), "\n").otherwise(" ")))
    return F.split(F.rtrim(F.array_join(closed, ""), F.lit("\n")), "\n")


def with_tree(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with ``name``: root, sections, paragraphs (nodes in order of the text) and all distinct nodes as 64-bit hashes."""
    body = F.coalesce(F.col(text), F.lit(""))
    phrases = F.split(F.regexp_replace(body, f"([^{PLAIN}])\\x20", "$1 \n"), "\n")
    rest = [c for c in df.columns if c != name]
    own = df.select(*rest, F.transform(F.split(body, "\n"), lambda x: F.sha2(x, 256)).alias("_paragraphs"))
    own = own.select(*rest, "_paragraphs", sections_of(F.col("_paragraphs")).alias("_runs"))
    own = own.select(*rest, "_paragraphs", F.transform("_runs", lambda x: F.sha2(x, 256)).alias("_sections"))
    own = own.select(*rest, "_paragraphs", "_sections", F.sha2(F.array_join("_sections", " "), 256).alias("_root"))
    level = lambda nodes, tag: F.transform(nodes, lambda x: F.xxhash64(F.lit(tag), x))
    nodes = F.array_distinct(
        F.concat(F.array(F.xxhash64(F.lit("root"), "_root")), level(F.col("_sections"), "section"), level(F.col("_paragraphs"), "paragraph"), level(phrases, "phrase"))
    )
    tree = F.struct(F.col("_root").alias("root"), F.col("_sections").alias("sections"), F.col("_paragraphs").alias("paragraphs"), nodes.alias("nodes"))
    return own.select(*rest, tree.alias(name))


def likeness(left: Column, right: Column) -> Column:
    """The share of nodes that two trees have in common, from 0 to 1."""
    shared = F.size(F.array_intersect(left["nodes"], right["nodes"]))
    return (2 * shared).cast("double") / (F.size(left["nodes"]) + F.size(right["nodes"]))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, tree) of every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("_body"), F.char_length(body).cast("long").alias("n_chars"))
    return with_tree(rows, "_body", "tree").drop("_body")


def edits(before: DataFrame, after: DataFrame) -> DataFrame:
    """Where two versions differ: (doc_id, side, section, paragraph, node), from two results of ``fingerprints``.

    ``side`` is removed (only before has the paragraph) or added (only after has it); places count from 0, paragraphs
    within their section. Rows meet by doc_id, NULL ids too. Documents with equal roots, and sections that the other
    version has anywhere, are not descended into; a paragraph that moved between edited sections is no edit. Of
    repeated ids, a branch counts as shared when any row of the id has it. An id that one side lacks gives every
    paragraph of the other.
    """

    def opened(own: DataFrame, other: DataFrame, side: str) -> DataFrame:
        same_id = lambda o: F.col("doc_id").eqNullSafe(F.col(o))
        roots = other.select(F.col("doc_id").alias("_id"), F.col("tree.root").alias("_root"))
        changed = own.join(roots, same_id("_id") & (F.col("tree.root") == F.col("_root")), "left_anti")
        runs = sections_of(F.col("tree.paragraphs"))
        sections = changed.select("doc_id", F.posexplode(runs).alias("section", "run"))
        shared = other.select(F.col("doc_id").alias("_id"), F.explode("tree.sections").alias("_section"))
        sections = sections.join(shared, same_id("_id") & (F.sha2("run", 256) == F.col("_section")), "left_anti")
        below = sections.select("doc_id", "section", F.posexplode(F.split(F.rtrim("run"), " ")).alias("paragraph", "node"))
        theirs = other.select(F.col("doc_id").alias("_id"), F.explode("tree.paragraphs").alias("_node"))
        left = below.join(theirs, same_id("_id") & (F.col("node") == F.col("_node")), "left_anti")
        return left.select("doc_id", F.lit(side).alias("side"), "section", "paragraph", "node")

    return opened(before, after, "removed").unionByName(opened(after, before, "added"))


def with_next_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text): each text (never NULL) with that of the next document in descending id order.

    After the last comes the first again. NULL ids come last; rows of one id follow each other by the hash of their
    text. The order is cut into chunks of about CHUNK_BYTES of text, so no task holds more of it than that, one text,
    or rows equal in id and text.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", body.alias("text"), F.xxhash64(body).alias("_tie"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    per_chunk = max(1, int(size["n"] * CHUNK_BYTES / max(size["b"] or 0, 1)))
    order = ["doc_id", "_tie"]
    stepped = with_previous(rows, [], order, {"_next": "text"}, find_cuts(rows, [], order, per_chunk))
    first = rows.orderBy(F.desc_nulls_last("doc_id"), F.desc("_tie")).limit(1).select("text").scalar()
    return stepped.select("doc_id", "text", F.coalesce("_next", first).alias("next_text"))


def with_edit(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text, edited): the last third of each text replaced by the head of the next one's."""
    third = F.floor(F.char_length("text") / 3).cast("int")
    kept = F.substring("text", F.lit(1), F.char_length("text") - third)
    return with_next_text(docs).withColumn("edited", F.concat(kept, F.substring("next_text", F.lit(1), third)))
