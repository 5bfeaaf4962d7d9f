"""Line dedup by log templates: a tree of fixed depth finds lines that recur with variable fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.bind import let
from shelfwise.llm.common import Work, fresh, text_key

#: leading tokens that lead to a leaf of the tree, below the number of tokens
DEPTH = 3
#: lines with fewer tokens are short: their leaf is the whole line, they need more documents and
#: half of their tokens constant
MIN_TOKENS = 3
MIN_DOCS_SHORT = 20
MIN_CONSTANT_SHORT = 0.5
#: documents in which a template recurs, if it is a line as it stands, and if it has variable fields
MIN_DOCS = 5
MIN_DOCS_VARIABLE = 10
#: constant lines of so many tokens are long, and recur in so many documents already
LONG_TOKENS = 10
LONG_DOCS = 2
#: share of a template's tokens that must be constant
MIN_CONSTANT = 0.7
FIELD = "<*>"


_OTHER_WHITE = ("\t", "\x0b", "\x0c", "\r", "  ")


def normal(line: Column) -> Column:
    """A line's tokens with one blank between them; tokens with a digit are fields from the start.

    Most lines are so already, so it is only looked whether they are.
    """
    uneven = line.startswith(" ") | line.endswith(" ")
    for white in _OTHER_WHITE:
        uneven = uneven | F.contains(line, F.lit(white))
    plain = F.when(uneven, F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))).otherwise(line)
    return F.when(line.rlike("[0-9]"), F.regexp_replace(plain, "[^ ]*[0-9][^ ]*", FIELD)).otherwise(plain)


def _indexed(docs: DataFrame) -> DataFrame:
    """A row for each document with its lines as hashes of their normal form, their leaf and their number.

    The lines of a document are sorted, so equal ones are neighbours. Rows equal in id and
    text become one.
    """

    def parsed(line: Column, at: Column) -> Column:
        def fields(form: Column) -> Column:
            blanks = F.length(form) - F.length(F.replace(form, F.lit(" ")))
            leaf = F.xxhash64(blanks, F.substring_index(form, " ", DEPTH))
            return F.when(form != "", F.struct(F.xxhash64(form, blanks).alias("form"), leaf.alias("leaf"), at.alias("at")))

        return let(normal(line), fields)

    lines = F.filter(F.transform(F.split("text", "\n"), parsed), lambda x: x.isNotNull())
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    given = given.filter("text IS NOT NULL").select("doc_id", "text_key", F.array_sort(lines).alias("lines"))
    return given.groupBy("doc_id", "text_key").agg(F.first("lines").alias("lines"))


#: forms and templates with this share of all lines or more are crowded; there are at most 1 / CROWDED of them
CROWDED = 0.001


class LineTemplates:
    """Templates of the lines of a corpus, and the lines that are dropped for them.

    A line is cut into tokens; tokens with a digit become fields. Its leaf is given by its
    number of tokens and the first DEPTH of them. Within a leaf, a token stays in the template where
    at least min_docs different documents have it at the same place; elsewhere the template has a
    field. This does not depend on the order of lines, unlike a parser that reads a stream. A template
    recurs if its lines are in enough documents and enough of it is constant. A long line as it
    stands recurs in long_docs documents already. Of the lines of a recurring template, one
    stays: the first of the document with the smallest id.

    Leaves are counted on hashes first, so that only lines of leaves with several documents are
    cut into token rows, and each distinct line of a leaf only once, with the number of
    its documents: a line that a third of all documents have is one row after the map side,
    and its text is read from one of them.
    Where lines meet forms or templates again, the crowded ones, whose number is bounded, are
    broadcast, and the others shuffled. Documents are told apart by id and text; rows equal
    in both are one.
    """

    def __init__(
        self,
        docs: DataFrame,
        work: Work,
        min_docs: int = MIN_DOCS,
        min_docs_variable: int = MIN_DOCS_VARIABLE,
        long_docs: int = LONG_DOCS,
    ):
        self.docs, self.work = docs, work
        self.min_docs, self.min_docs_variable, self.long_docs = min_docs, min_docs_variable, min(long_docs, min_docs)

    def _met(self, many: DataFrame, few: DataFrame, on: list[str], rows: int) -> DataFrame:
        """many joined with few, a kept table with docs, by keys that are unique in few."""
        crowded = F.col("docs") >= CROWDED * rows
        some = F.broadcast(few.filter(crowded).drop("docs"))
        return many.join(some, on).unionByName(many.join(few.filter(~crowded).drop("docs"), on))

    def _common(self, parts: DataFrame, index: DataFrame) -> DataFrame:
        """leaf, place and token of what at least min_docs different documents have there.

        A token whose forms have too few documents together or enough in one form is decided
        by these numbers; only for the others are the owners of their forms, which are
        fewer than min_docs each, told apart.
        """
        at = ["leaf", "place", "token"]
        support = parts.filter(F.col("token") != FIELD).groupBy(*at).agg(
            F.sum("docs").alias("most"), F.max("docs").alias("least")
        )
        support = self.work.keep(support.filter(F.col("most") >= self.min_docs))
        open_ = parts.join(support.filter(F.col("least") < self.min_docs).select(*at), at)
        owners = open_.select(*at, "form").join(index.select("leaf", "form", "doc_id", "text_key"), ["leaf", "form"])
        owners = owners.select(*at, "doc_id", "text_key").distinct().groupBy(*at).agg(F.count(F.lit(1)).alias("docs"))
        told = owners.filter(F.col("docs") >= self.min_docs).select(*at)
        return support.filter(F.col("least") >= self.min_docs).select(*at).unionByName(told)

    def _tokens(self, wanted: DataFrame) -> DataFrame:
        """wanted with the tokens of its forms, read from the one document that each names."""
        names = [c for c in wanted.columns if c not in ("doc_id", "text_key")]
        named = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct(*names)).alias("named"))
        named = named.withColumnsRenamed({"doc_id": "of_id", "text_key": "of_key"})
        texts = self.docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
        met = texts.join(named, texts["doc_id"].eqNullSafe(named["of_id"]) & (texts["text_key"] == named["of_key"]))
        lines = met.select("named", F.split("text", "\n").alias("lines"))
        raw = F.transform("named", lambda n: F.struct(*(n[c].alias(c) for c in names), F.get("lines", n["at"]).alias("raw")))
        rows = lines.select(F.inline(raw)).drop("at")
        # a document that is there as several rows gives its forms as often
        return rows.dropDuplicates(["leaf", "form"]).withColumn("tokens", F.split(normal(F.col("raw")), " ")).drop("raw")

    def dropped(self) -> DataFrame:
        """doc_id, text_key, at: the lines (numbered from 0) that are dropped."""
        whole = self.work.keep(_indexed(self.docs))
        rows = whole.agg(F.sum(F.size("lines"))).first()[0] or 0
        index = whole.select("doc_id", "text_key", F.inline("lines"))
        # a form counts once for each document; any document that has it gives its tokens
        first = lambda x, i: (i == 0) | (F.get("lines", i - 1)["form"] != x["form"])
        forms = whole.select("doc_id", "text_key", F.inline(F.filter("lines", first))).groupBy("leaf", "form")
        forms = forms.agg(F.count(F.lit(1)).alias("docs"), *(F.first(c).alias(c) for c in ("doc_id", "text_key", "at")))
        forms = self.work.keep(forms)
        leaves = forms.groupBy("leaf").agg(F.sum("docs").alias("docs"), F.count(F.lit(1)).alias("forms"))
        full = leaves.filter(F.col("docs") >= self.long_docs).select("leaf", "forms")
        distinct = self.work.keep(self._tokens(forms.join(full, "leaf")))
        single = distinct.filter("forms = 1").select("leaf", "form", "docs", "tokens")
        several = distinct.filter("forms > 1")
        parts = several.select("leaf", "form", "docs", F.posexplode("tokens").alias("place", "token"))
        common = self._common(parts, index)
        kept = parts.join(common, ["leaf", "place", "token"])
        constants = kept.groupBy("leaf", "form").agg(F.collect_list(F.struct("place", "token")).alias("constants"))
        merged = several.select("leaf", "form", "docs", F.size("tokens").alias("size")).join(
            constants, ["leaf", "form"], "left"
        )
        merged = merged.withColumn("constants", F.coalesce("constants", F.array().cast("array<struct<place:int,token:string>>")))
        template = F.xxhash64(F.to_json(F.array_sort("constants"))).alias("template")
        merged = merged.select("leaf", "form", "docs", "size", F.size("constants").alias("fixed"), template)
        alone_fixed = F.size(F.filter("tokens", lambda t: t != FIELD))
        alone = single.select(
            "leaf", "form", "docs", F.size("tokens").alias("size"), alone_fixed.alias("fixed"), F.col("form").alias("template")
        )
        every = self.work.keep(merged.unionByName(alone))
        # the documents of a template are at most the sum over its forms and at least their maximum
        totals = every.groupBy("leaf", "template").agg(
            F.sum("docs").alias("docs"), F.first("size").alias("size"), F.first("fixed").alias("fixed")
        )
        short = F.col("size") < MIN_TOKENS
        needed = (
            F.when(short, MIN_DOCS_SHORT)
            .when(F.col("fixed") == F.col("size"), self.min_docs)
            .otherwise(self.min_docs_variable)
        )
        constant = F.when(short, MIN_CONSTANT_SHORT).otherwise(MIN_CONSTANT)
        likely = totals.filter((F.col("docs") >= needed) & (F.col("fixed") >= constant * F.col("size")))
        candidates = every.join(
            likely.select("leaf", "template", needed.alias("needed")), ["leaf", "template"]
        ).select("leaf", "form", "docs", "template", "needed")
        if self.long_docs < self.min_docs:
            # a long line as it stands is a template of its own, within that of the tree: what stays of
            # the tree's is the first of its own too, so both can be dropped by
            long = distinct.filter((F.size("tokens") >= LONG_TOKENS) & ~F.array_contains("tokens", FIELD))
            long = long.filter(F.col("docs") >= self.long_docs).select(
                "leaf", "form", "docs", F.xxhash64(F.lit("long"), "form").alias("template"), F.lit(self.long_docs).alias("needed")
            )
            candidates = candidates.unionByName(long)
        hits = self._met(index, self.work.keep(candidates), ["leaf", "form"], rows)
        hits = self.work.keep(hits.select("doc_id", "text_key", "at", "leaf", "template", "needed"))
        place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "at")
        per_doc = hits.groupBy("leaf", "template", "doc_id", "text_key").agg(F.min(place).alias("first"), F.first("needed").alias("needed"))
        recurring = per_doc.groupBy("leaf", "template").agg(
            F.count(F.lit(1)).alias("docs"), F.min("first").alias("stays"), F.first("needed").alias("needed")
        )
        recurring = self.work.keep(recurring.filter("docs >= needed").select("leaf", "template", "stays", "docs"))
        gone = self._met(hits, recurring, ["leaf", "template"], rows).filter(place != F.col("stays"))
        return gone.select("doc_id", "text_key", "at").distinct()


def without_recurring_lines(docs: DataFrame, work: Work, **params) -> DataFrame:
    """docs with their lines of recurring templates dropped from text, and n_lines and n_dropped.

    The remaining lines stay as they are, in order. A null text stays null and has no lines; an
    empty text has one line. Rows equal in id and text lose the same lines. All columns of docs
    pass through; counts that clash with one are named with a trailing underscore.
    """
    gone = LineTemplates(docs, work, **params).dropped()
    gone = work.keep(gone.groupBy("doc_id", "text_key").agg(F.collect_list("at").alias("gone")))
    key, mark = fresh(docs, "text_key"), fresh(docs, "gone")
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"), F.col("gone").alias(mark))
    keyed = docs.withColumn(key, text_key())
    joined = keyed.join(
        gone, keyed["doc_id"].eqNullSafe(gone["gone_id"]) & (keyed[key] == gone["gone_key"]), "left"
    ).drop(gone["gone_id"], gone["gone_key"])
    lines = F.split("text", "\n")
    left = F.filter(lines, lambda _, at: ~F.array_contains(F.col(mark), at))
    text = F.when(F.col(mark).isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    n_lines, n_dropped = fresh(docs, "n_lines"), fresh(docs, "n_dropped")
    counts = {
        n_lines: F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"),
        n_dropped: F.when(F.col(mark).isNull(), 0).otherwise(F.size(mark)).cast("long"),
    }
    return joined.withColumns(counts).withColumn("text", text).drop(key, mark)
