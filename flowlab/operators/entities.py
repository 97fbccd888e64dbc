"""TXT7 resolved: entities from dictionaries and typed patterns, no two of which overlap.

Dictionaries are tables (term, type, score). All terms of a block of them are found in one pass
over a text by an Aho-Corasick automaton, which every task builds from the block; a larger
dictionary is searched block by block. The matches join those of the typed patterns (card numbers
only if their check digit is right), and of all spans of a document the set of disjoint ones
with the largest total of score times length is kept (weighted interval scheduling)."""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ranking import dense_index
from .text import entities

#: Terms of a block: what the driver reads and a task's automaton holds.
BLOCK_TERMS = 100_000
#: Scores of the typed patterns, as confidences; the looser a pattern, the lower.
PATTERN_SCORES = {"EMAIL": 1.0, "URL": 1.0, "PHONE": 0.95, "IP_ADDRESS": 0.9, "CARD_NUMBER": 0.95, "SECRET": 1.0, "DATE": 0.9, "QUANTITY": 0.6}
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _found(automaton, text: str) -> list[tuple[int, int, str, float]]:
    """(begin, end, type, score) of all whole-word terms in a text; A-Z match in either case."""
    low, out = text.translate(_LOWER), []
    for last, held in automaton.iter(low):
        for size, kind, score in held:
            begin, end = last + 1 - size, last + 1
            if not (begin and low[begin - 1].isalnum() and low[begin].isalnum()) and not (end < len(low) and low[end].isalnum() and low[end - 1].isalnum()):
                out.append((begin, end, kind, score))
    return out


def _blocks(dictionary: DataFrame, size: int) -> list[list[tuple[str, str, float]]]:
    terms = dictionary.select(F.translate(F.trim("term"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("term"), F.col("type"), F.col("score").cast("double")) \
        .where("term <> '' and type is not null").groupBy("term", "type").agg(F.max("score").alias("score"))
    terms = cut_lineage(terms)
    n = terms.select("term").distinct().count()
    if n <= size:
        return [[tuple(r) for r in terms.collect()]] if n else []
    numbered = cut_lineage(terms.join(dense_index(terms, "term", "__i"), "term"))
    return [[tuple(r) for r in numbered.where(F.expr(f"__i div {size}") == b).select("term", "type", "score").collect()] for b in range(-(-n // size))]


def dictionary_entities(docs: DataFrame, dictionary: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(doc, Type, Text, BeginOffset, EndOffset, Score): every whole-word occurrence of a term, those
    inside others too. One scan of the texts for each block of the dictionary."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, Type string, Text string, BeginOffset bigint, EndOffset bigint, Score double"
    out = None
    for block in _blocks(dictionary, block_terms):
        def run(batches, block=tuple(block)):
            import ahocorasick

            held: dict[str, list] = {}
            for term, kind_of, score in block:
                held.setdefault(term, []).append((len(term), kind_of, score))
            automaton = ahocorasick.Automaton()
            for term, rows in held.items():
                automaton.add_word(term, rows)
            automaton.make_automaton()
            for b in batches:
                for i in range(0, b.num_rows, 256):
                    part = b.slice(i, 256)
                    at, rows = [], []
                    for k, text in enumerate(part.column(1).to_pylist()):
                        for begin, end, kind_of, score in _found(automaton, text or ""):
                            at.append(k)
                            rows.append((kind_of, text[begin:end], begin, end, score))
                    if rows:
                        cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64()))]
                        yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at, pa.int64())), *cols], names=[id_col, "Type", "Text", "BeginOffset", "EndOffset", "Score"])

        found = docs.select(id_col, docs[text_col].cast("string")).mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def luhn(digits):
    """Whether the check digit of a number (a string of digits) is right, as a column."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def best_disjoint(spans: list[tuple[int, int, float]]) -> list[int]:
    """The disjoint spans (begin, end, weight) of the largest total weight, as their places in order;
    of equal sets the one found first by end, begin and place."""
    order = sorted(range(len(spans)), key=lambda i: (spans[i][1], spans[i][0], i))
    ends = [spans[i][1] for i in order]
    best = [0.0] * (len(order) + 1)
    before = []
    for k, i in enumerate(order):
        begin, _, weight = spans[i]
        before.append(bisect_right(ends, begin, 0, k))
        best[k + 1] = max(best[k], best[before[k]] + weight)
    out, k = [], len(order)
    while k:
        if best[k] == best[k - 1]:
            k -= 1
        else:
            out.append(order[k - 1])
            k = before[k - 1]
    return out[::-1]


def resolved_entities(docs: DataFrame, dictionary: DataFrame, patterns=None, id_col: str = "doc_id", text_col: str = "text",
                      pattern_scores=None, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """TXT7. (doc, Type, Text, BeginOffset, EndOffset, Score) of disjoint spans: of all matches of the
    dictionary's terms and the patterns, for each document the disjoint set with the largest sum of
    score times length. Card numbers need a right check digit. Null texts have no entities; ids
    should tell documents apart."""
    scores = PATTERN_SCORES | (pattern_scores or {})
    score = F.coalesce(F.element_at(F.create_map(*[x for k, v in scores.items() for x in (F.lit(k), F.lit(v))]), F.col("Type")), F.lit(0.5))
    typed = entities(docs, patterns, id_col, text_col).where((F.col("Type") != "CARD_NUMBER") | luhn(F.col("Text"))).withColumn("Score", score)
    every = typed.unionByName(dictionary_entities(docs, dictionary, id_col, text_col, block_terms))
    # a document's spans: bounded by its length
    spans = every.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("BeginOffset", "EndOffset", "Type", "Score", "Text"))).alias("spans"))
    kind = docs.schema[id_col].dataType.simpleString()
    span = "array<struct<BeginOffset: bigint, EndOffset: bigint, Type: string, Score: double, Text: string>>"

    def run(batches):
        for b in batches:
            kept = []
            for row in b.column(1).to_pylist():
                own = [(s["BeginOffset"], s["EndOffset"], s["Score"] * (s["EndOffset"] - s["BeginOffset"])) for s in row]
                kept.append([row[i] for i in best_disjoint(own)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, b.column(1).type)], names=[id_col, "spans"])

    return spans.mapInArrow(run, f"{id_col} {kind}, spans {span}").select(id_col, F.inline("spans")) \
        .select(id_col, "Type", "Text", "BeginOffset", "EndOffset", "Score")
