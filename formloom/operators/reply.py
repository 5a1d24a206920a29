"""Replies pasted from a chat: the table within the text, its cells, and the proposals they make; batches to ask for.

Validation gives rows of errors; callers decide whether to stop. texts: doc_id, text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import let

EXCERPT = 2000
#: Fixed value: a row of a table's bars, dashes and colons alone.
SEPARATOR = r"^\s*\|?[\s:|-]+\|?\s*$"
FIELDS = ["row_id", "kind", "domain", "variable", "variable2", "condition", "codelist", "origin", "confidence", "rationale"]


def lines(text: Column) -> Column:
    """The lines of a text without fences and smart quotes."""
    return F.split(T.pasted(text), "\r?\n")


def until(told: Column, first: Column, ends: Callable[[Column], Column]) -> Column:
    """Of an array of lines: (n, line) from the place `first`, 1 or more, to what comes before the next line that `ends`; null for place 0."""
    rest = F.transform(F.slice(told, first, F.size(told)), lambda x, i: F.struct((first - 1 + i).cast("int").alias("n"), x.alias("line")))
    stop = lambda r: F.array_position(F.transform(r, lambda x, i: (i > 0) & ends(x["line"])), True)
    return F.when(first > 0, let(rest, lambda r: let(stop(r), lambda k: F.when(k > 0, F.slice(r, 1, (k - 1).cast("int"))).otherwise(r))))


def markdown_table(told: Column) -> Column:
    """(n, line) of the first table among a text's lines: a row of bars, a separator below it, and the rows that follow at once."""
    bar = lambda x: F.trim(x).rlike(r"^\|.+\|$")
    head = F.array_position(F.transform(told, lambda x, i: bar(x) & F.coalesce(F.get(told, i + 1).rlike(SEPARATOR), F.lit(False))), True)
    return let(head.cast("int"), lambda k: until(told, F.greatest(k, F.lit(0)), lambda x: ~bar(x)))


def markdown_block(texts: DataFrame) -> DataFrame:
    """(doc_id, n, line) of each text's markdown_table()."""
    return once(texts.select("doc_id", let(lines(F.col("text")), markdown_table).alias("_l")), "_l").select("doc_id", F.explode("_l").alias("_l")).select("doc_id", "_l.*")


def once(df: DataFrame, column: str) -> DataFrame:
    """The column as a generated row's, so that what reads it several times does not work it out again in each place."""
    return df.select(*[c for c in df.columns if c != column], F.explode(F.array(column)).alias(column))


def cells(line: Column) -> Column:
    """Of a row between bars."""
    return F.transform(F.split(F.regexp_replace(F.trim(line), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))


def header(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(name)), " ", "_")


def delimited_block(told: Column) -> Column:
    """A text's lines from the first that begins "row_id" and a delimiter to the next blank line, as one text: a block is one reply's table."""
    head = F.array_position(F.transform(told, lambda x: x.rlike(r"(?i)^\s*[\"']?row_id[\"']?\s*[,\t;]")), True)
    block = let(head.cast("int"), lambda k: until(told, F.greatest(k, F.lit(0)), lambda x: F.trim(x) == ""))
    return F.array_join(F.transform(block, lambda x: x["line"]), "\n")


#: A quoted cell, each character of it read once.
QUOTED = '"[^"]*+(?:""[^"]*+)*+"'


def csv_records(block: Column, delimiter: Column) -> Column:
    """The records of a delimited block as arrays of cells: lines, but for line ends within a quoted cell.

    Each cell is found by itself with what ends it, so neither a cell nor a record nor a block has a largest size.
    """
    text = F.concat(block, F.lit("\n"))
    cell = F.concat(F.lit(f"({QUOTED}(?=["), delimiter, F.lit("\n])|[^"), delimiter, F.lit("\n]*+)(["), delimiter, F.lit("\n])"))
    ends = F.regexp_extract_all(text, cell, F.lit(2))
    last = let(ends, lambda e: F.filter(F.sequence(F.lit(1), F.size(e)), lambda i: F.get(e, i - 1) == "\n"))
    told = F.struct(F.regexp_extract_all(text, cell, F.lit(1)).alias("cells"), last.alias("last"))

    def records(t: Column) -> Column:
        before = lambda i: F.when(i > 0, F.get(t["last"], i - 1)).otherwise(0)
        return F.transform(t["last"], lambda e, i: F.slice(t["cells"], before(i) + 1, e - before(i)))

    return let(told, records)


def csv_cells(record: Column) -> Column:
    """The texts of a record's cells: quotes around a cell may hold delimiters, line ends and doubled quotes."""
    inner = lambda c: F.regexp_replace(F.substring(c, F.lit(2), F.length(c) - 2), '""', '"')
    return F.transform(record, lambda c: F.trim(F.when(c.startswith('"') & c.endswith('"') & (F.length(c) > 1), inner(c)).otherwise(c)))


def read(text: Column) -> Column:
    """struct(table, heads, rows, wrong) of a text's markdown table, or else of its delimited block, all in one expression.

    rows are (n, cells): of a markdown table n is the line, and none is a separator; of a block n is the record's place,
    the header's is 0, and cells are as written. wrong are a markdown table's rows of another number of cells. Without
    either, all but `table` is null.
    """

    def told(table: bool, heads: Column, rows: Column) -> Column:
        wrong = lambda h, r: F.filter(r, lambda x: F.size(x["cells"]) != F.size(h)) if table else F.slice(r, 1, 0)
        return let(heads, lambda h: let(rows, lambda r: F.struct(F.lit(table).alias("table"), h.alias("heads"), r.alias("rows"), wrong(h, r).alias("wrong"))))

    def of_table(md: Column) -> Column:
        under = F.filter(F.slice(md, 2, F.size(md)), lambda x: ~x["line"].rlike(SEPARATOR))
        rows = F.transform(under, lambda x: F.struct(x["n"].alias("n"), cells(x["line"]).alias("cells")))
        return told(True, F.transform(cells(F.get(md, F.lit(0))["line"]), header), rows)

    def of_block(block: Column) -> Column:
        delimiter = F.regexp_extract(block, r"(?i)^\s*[\"']?row_id[\"']?\s*([,\t;])", 1)
        rows = lambda records: F.transform(F.slice(records, 2, F.size(records)), lambda r, i: F.struct((i + 1).cast("int").alias("n"), r.alias("cells")))
        return let(csv_records(block, delimiter), lambda records: told(False, F.transform(csv_cells(F.get(records, F.lit(0))), lambda h: F.lower(h)), rows(records)))

    return let(lines(text), lambda x: let(markdown_table(x), lambda md: F.when(md.isNotNull(), of_table(md)).otherwise(let(delimited_block(x), of_block))))


def parse(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, errors): a text's markdown table, whose failure is final; else its delimited block; else an error with an excerpt.

    rows are (doc_id, n, cells by header). In a markdown table rows with other numbers of cells are errors, and so is a table
    without rows; in a delimited block cells beyond the header are dropped, missing ones empty.
    """
    told = once(texts.withColumn("_t", read(F.col("text"))), "_t").select("doc_id", "text", "_t.*")
    each = told.filter(F.size("wrong") == 0).select("doc_id", "table", "heads", F.explode("rows").alias("_r"))
    said = F.when(F.col("table"), F.col("_r.cells")).otherwise(csv_cells(F.col("_r.cells")))
    padded = let(said, lambda c: F.transform("heads", lambda h, i: F.coalesce(F.get(c, i), F.lit(""))))
    good = once(each.select("doc_id", "_r.n", F.map_from_arrays("heads", padded).alias("row")), "row")
    raw = T.collapse_ends(F.col("text"))
    left = F.greatest(F.lit(0), F.length(raw) - EXCERPT)
    shown = F.when(left > 0, F.concat(F.substring(raw, 1, EXCERPT), F.format_string("\n... [%d more chars]", left))).otherwise(raw)
    of = lambda n, error, excerpt: F.struct(n.cast("int").alias("n"), error.alias("error"), excerpt.cast("string").alias("excerpt"))
    null, none = F.lit(None), F.coalesce(F.size("rows") < 1, F.lit(True))
    cut = F.transform("wrong", lambda r: of(r["n"], F.format_string("%d cells under %d headers", F.size(r["cells"]), F.size("heads")), null))
    found = F.when(F.col("table") & none, F.array(of(null, F.lit("no rows"), null))).when(none, F.array(of(null, F.lit("no table found"), shown))).otherwise(cut)
    return good, once(told.select("doc_id", found.alias("_f")), "_f").select("doc_id", F.explode("_f").alias("_e")).select("doc_id", "_e.*")


def scrubbed(rows: DataFrame) -> DataFrame:
    """Fields as columns; cells that say nothing are null; kinds and origins in their own spelling, null where unknown.

    said_kind, said_origin and said_confidence are the cells themselves.
    """
    at = lambda c: T.scrub(F.col("row")[c])
    return rows.select(
        "doc_id", "n", at("row_id").alias("row_id"), F.coalesce(T.coerce(at("kind"), T.KINDS), F.when(at("kind").isNull(), "variable")).alias("kind"),
        F.upper(at("domain")).alias("domain"), F.upper(at("variable")).alias("variable"), F.upper(at("variable2")).alias("variable2"),
        at("condition").alias("condition"), at("codelist").alias("codelist"), T.coerce(at("origin"), T.ORIGINS).alias("origin"),
        at("confidence").try_cast("double").alias("confidence"), at("rationale").alias("rationale"),
        at("kind").alias("said_kind"), at("origin").alias("said_origin"), at("confidence").alias("said_confidence"),
    )


def row_faults() -> Column:
    """What is wrong with a scrubbed row, one error for each thing; none for a proposal."""
    says = lambda what, c: F.concat(F.lit(f"{what}: "), F.col(c))
    sure = F.col("confidence")
    return F.array_compact(F.array(
        F.when(F.col("row_id").isNull(), F.lit("missing row_id")), F.when(F.col("kind").isNull(), says("unknown kind", "said_kind")),
        F.when(F.col("origin").isNull() & F.col("said_origin").isNotNull(), says("unknown origin", "said_origin")),
        F.when(F.col("said_confidence").isNotNull() & (sure.isNull() | F.isnan(sure) | ~sure.between(0, 1)), says("confidence is not from 0 to 1", "said_confidence")),
    ))


def row_errors(fields: DataFrame) -> DataFrame:
    """(doc_id, n, row_id, error) of scrubbed rows that are no proposal; one error for each thing that is wrong."""
    return fields.select("doc_id", "n", "row_id", F.explode(row_faults()).alias("error"))


def proposals(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(proposals, errors): a reply with a row that is wrong gives its errors and no proposal, since it is to be mended whole."""
    fields = scrubbed(rows)
    whole = fields.withColumn("_wrong", F.max(F.size(row_faults()) > 0).over(W.partitionBy("doc_id"))).filter(~F.col("_wrong"))
    return expanded(whole.drop("said_kind", "said_origin", "said_confidence", "_wrong")), row_errors(fields)


def expanded(proposals: DataFrame) -> DataFrame:
    """A second variable as a proposal of its own for slot 2, without condition and rationale."""
    one = F.struct(F.lit(1).alias("slot"), "variable", "condition", "rationale")
    null = F.lit(None).cast("string")
    two = F.when(F.col("variable2").isNotNull(), F.struct(F.lit(2).alias("slot"), F.col("variable2").alias("variable"), null.alias("condition"), null.alias("rationale")))
    rest = [c for c in proposals.columns if c not in ("variable", "variable2", "condition", "rationale")]
    return proposals.select(*rest, F.explode(F.filter(F.array(one, two), lambda x: x.isNotNull())).alias("_p")).select(*rest, "_p.*")


def attach(proposals: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(annotations, errors): proposals with their row, repeated ids told apart by -2, -3; rows that there are none of."""
    known = proposals.join(rows, ["doc_id", "row_id"])
    k = F.row_number().over(W.partitionBy("doc_id", "row_id", "slot").orderBy("n"))
    base = F.concat("row_id", F.lit("_a"), F.col("slot"))
    out = known.withColumn("_k", k).withColumn("annot_id", F.when(F.col("_k") > 1, F.concat(base, F.lit("-"), F.col("_k"))).otherwise(base)).drop("_k")
    return out, proposals.join(rows.select("doc_id", "row_id"), ["doc_id", "row_id"], "left_anti").select("doc_id", "row_id", F.lit("unknown row").alias("error"))


def missing(asked: DataFrame, proposals: DataFrame) -> DataFrame:
    """Rows that were asked for and have no proposal."""
    return asked.select("doc_id", "row_id").join(proposals.select("doc_id", "row_id").distinct(), ["doc_id", "row_id"], "left_anti")


def batches(pages: DataFrame, most: int = 150) -> DataFrame:
    """(doc_id, page_index, batch) from (doc_id, page_index, n): pages in order fill a batch up to `most` rows; none is split.

    A fold over each document's pages in order: a page that does not fit opens the next batch.
    """
    told = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_index", F.col("n").cast("long").alias("n")))).alias("_p"))
    zero = F.expr("struct(0L as held, 1 as batch, cast(array() as array<struct<page_index:int,batch:int>>) as out)")

    def add(acc: Column, p: Column) -> Column:
        fresh = (acc["held"] > 0) & (acc["held"] + p["n"] > most)
        batch = F.when(fresh, acc["batch"] + 1).otherwise(acc["batch"])
        return F.struct(F.when(fresh, p["n"]).otherwise(acc["held"] + p["n"]).alias("held"), batch.alias("batch"), F.concat(acc["out"], F.array(F.struct(p["page_index"].cast("int").alias("page_index"), batch.alias("batch")))).alias("out"))

    return told.select("doc_id", F.explode(F.aggregate("_p", zero, add, lambda a: a["out"])).alias("_o")).select("doc_id", "_o.page_index", "_o.batch")


#: Labels that a word may stand in and still be looked up by itself.
LIGHT = 256


def appendix_pairs(lookup: DataFrame, words: DataFrame, most: int = 20, light: int = LIGHT) -> DataFrame:
    """(doc_id, label, count, overlap): pairs among which each batch's best `most` labels are, with all that they share.

    A word of at most `light` labels leads to each of them. Heavier words lead nowhere by themselves: labels are classes by
    the heavy words that they hold, a class has its best `most` labels, and batches are classes likewise. Of labels that a
    batch shares heavy words with alone, its best `most` are the best of what its class meets: whatever beats one of them
    on heavy words beats it with light words added. So a word of all labels and batches makes one pair of classes.
    """
    of = lookup.groupBy("label").agg(F.max(F.col("count").cast("int")).alias("count")).withColumn("word", F.explode(T.label_words(F.col("label"))))
    heavy = of.groupBy("word").agg(F.count("*").alias("_n")).filter(F.col("_n") > light).select("word")
    own = words.select("doc_id", "word").distinct()
    kind = lambda df: df.join(heavy, "word", "left_semi")
    rare = lambda df: df.join(heavy, "word", "left_anti")
    held = F.array_sort(F.collect_list("word"))
    labels, batches = kind(of).groupBy("label", "count").agg(held.alias("class")), kind(own).groupBy("doc_id").agg(held.alias("kind"))
    best = labels.withColumn("_r", F.row_number().over(W.partitionBy("class").orderBy(F.desc("count"), "label"))).filter(F.col("_r") <= most).drop("_r")
    classes, kinds = (df.select(c).distinct().withColumn("word", F.explode(c)) for df, c in ((best, "class"), (batches, "kind")))
    met = kinds.join(classes, "word").groupBy("kind", "class").agg(F.count("*").alias("overlap")).join(best, "class")
    place = F.row_number().over(W.partitionBy("kind").orderBy(F.desc("overlap"), F.desc("count"), "label"))
    told = ["doc_id", "label", "count", "overlap"]
    by_heavy = batches.join(met.withColumn("_r", place).filter(F.col("_r") <= most), "kind").select(*told)
    by_light = rare(own).join(rare(of), "word").groupBy("doc_id", "label", "count").agg(F.count("*").alias("_light"))
    both = by_light.join(labels.select("label", "class"), "label", "left").join(batches, "doc_id", "left")
    shared = F.col("_light") + F.coalesce(F.size(F.array_intersect("class", "kind")), F.lit(0))
    return by_heavy.unionByName(both.withColumn("overlap", shared).select(*told)).groupBy("doc_id", "label", "count").agg(F.max("overlap").alias("overlap"))


def appendix(lookup: DataFrame, words: DataFrame, most: int = 20, light: int = LIGHT) -> DataFrame:
    """(doc_id, label, overlap, count, place): the lookup labels that share most words with a batch's words (doc_id, word).

    Ties go to the count, then the label.
    """
    place = F.row_number().over(W.partitionBy("doc_id").orderBy(F.desc("overlap"), F.desc("count"), "label"))
    return appendix_pairs(lookup, words, most, light).withColumn("place", place).filter(F.col("place") <= most)


#: Pairs of label and word of a lookup that each task holds; beyond them, batches and labels meet in joins.
HELD = 1 << 20
#: Labels of batches, and meetings of their words with labels, that a task counts at once.
COUNTED = 1 << 21


def appendix_of(lookup: DataFrame, batches: DataFrame, most: int = 20, held: int = HELD) -> DataFrame:
    """As appendix(), from batches (doc_id, words), an array of words each; of one doc_id several may come.

    A lookup of at most `held` pairs of label and word goes to every task, so that a batch finds its labels where it is: it is
    sent once, as the numbers of the words that the lookup knows. No pair of batch and label is sent.
    """
    best = lookup.groupBy("label").agg(F.max(F.col("count").cast("int")).alias("count"))
    told = best.withColumn("words", T.label_words(F.col("label")))
    if (told.agg(F.sum(F.size("words"))).first()[0] or 0) > held:
        return appendix(lookup, batches.select("doc_id", F.explode("words").alias("word")), most)
    labels = told.filter(F.size("words") > 0).orderBy(F.desc("count"), "label").toArrow()
    label, count, words = (labels[c].combine_chunks() for c in ("label", "count", "words"))
    word = pc.dictionary_encode(words.flatten())
    number, of = word.indices.to_numpy(), np.repeat(np.arange(len(label)), pc.list_value_length(words).to_numpy())
    by_word = np.argsort(number, kind="stable")
    index = (word.dictionary, np.cumsum(np.bincount(number, minlength=len(word.dictionary))), of[by_word])
    kind = f"doc_id {batches.schema['doc_id'].dataType.simpleString()}"
    known = batches.select("doc_id", "words").mapInArrow(lambda b: known_words(b, index[0]), f"{kind}, words array<int>")
    once = known.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("words"))).alias("words"))
    schema = f"{kind}, label string, overlap bigint, count int, place int"
    return once.mapInArrow(lambda b: best_labels(b, label, count, index[1], index[2], most), schema)


def known_words(batches: Iterator[pa.RecordBatch], vocabulary: pa.Array) -> Iterator[pa.RecordBatch]:
    """Each batch's words as their places in the vocabulary, without those that it lacks."""
    for b in batches:
        of, place = pc.list_parent_indices(b.column(1)).to_numpy(), pc.index_in(pc.list_flatten(b.column(1)), value_set=vocabulary)
        known = place.is_valid()
        size = np.bincount(of[known.to_numpy(zero_copy_only=False)], minlength=b.num_rows)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), place.filter(known).cast(pa.int32()))
        yield pa.RecordBatch.from_arrays([b.column(0), lists], names=["doc_id", "words"])


def best_labels(batches: Iterator[pa.RecordBatch], label: pa.Array, count: pa.Array, until: np.ndarray, of: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """The `most` labels that share most words with each batch; labels are in order of count and name, a word's are of[until[w - 1]:until[w]]."""
    n, most = len(label), min(most, len(label))
    many = np.diff(until, prepend=0)
    for b in batches:
        own, w = pc.list_parent_indices(b.column(1)).to_numpy(), pc.list_flatten(b.column(1)).to_numpy()
        met = np.cumsum(np.bincount(own, weights=many[w], minlength=b.num_rows)) if n else np.zeros(b.num_rows)
        i = 0 if n else b.num_rows
        while i < b.num_rows:
            k = max(i + 1, min(i + COUNTED // n, int(np.searchsorted(met, (met[i - 1] if i else 0) + COUNTED, side="right"))))
            low, high = np.searchsorted(own, [i, k])
            part, size = w[low:high], many[w[low:high]]
            at = of[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(until[part] - size, size)]
            overlap = np.bincount(np.repeat(own[low:high] - i, size) * n + at, minlength=(k - i) * n).reshape(k - i, n)
            rank = overlap * n + np.arange(n - 1, -1, -1)
            top = np.argpartition(-rank, most - 1, axis=1)[:, :most]
            top = np.take_along_axis(top, np.argsort(-np.take_along_axis(rank, top, axis=1), axis=1), axis=1)
            shared = np.take_along_axis(overlap, top, axis=1)
            row, place = np.nonzero(shared)
            found = pa.array(top[row, place])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row + i)), label.take(found), pa.array(shared[row, place]), count.take(found), pa.array((place + 1).astype(np.int32))], names=["doc_id", "label", "overlap", "count", "place"])
            i = k


def spec_sheet(rows: DataFrame) -> DataFrame:
    """Rows in reading order with the blank columns that a reply fills, as lines of text of one file for each document."""
    quoted = lambda c: F.concat(F.lit('"'), F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), '"', '""'), F.lit('"'))
    line = F.concat_ws(",", quoted("row_id"), quoted("page"), quoted("form"), quoted("text_1"), quoted("text_2"), *[F.lit("")] * 9)
    told = rows.withColumn("page", F.col("page_index") + 1).select("doc_id", F.struct("row_ord", line.alias("line")).alias("l"))
    head = "row_id,page,form,text_1,text_2,kind,domain,variable,variable2,condition,codelist,origin,confidence,rationale"
    return told.groupBy("doc_id").agg(F.concat(F.lit(head + "\n"), F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["line"]), "\n")).alias("csv"))
