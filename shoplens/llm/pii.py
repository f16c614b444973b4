"""Personal data: pattern matching, then bootstrapped contextual extraction.

Fixed expressions find e-mail and IP addresses, card and phone numbers. These
are the seeds. Each seed, and each other identifier-shaped token, stands in
lexical patterns: the words around it. A pattern's confidence for a kind is the
summed score of the distinct values of that kind seen in it, over all distinct
values seen in it (plus one). A value's score is the noisy-or of its confident
patterns. Spark joins the graph of patterns and values in turns; values that
confident patterns find are added, and count as evidence in the next turn.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import free_names, save, text_slices

KINDS = ("email", "ip", "card", "phone")
#: Distinct seeds a pattern needs, and lowest confidences.
SUPPORT, PATTERN_CONFIDENCE, VALUE_SCORE = 3, 0.7, 0.9
#: The graph takes turns until one adds no value; more than this many raise ``NotSettled``.
MOST_ROUNDS = 50
#: Context words above this length stand by a digest.
LONG_WORD = 40

# The base expressions.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_HINT = re.compile(r"[0-9@][^\x20\x09-\x0D]*")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_GROUP = re.compile(r"[0-9]+")
#: Neighbouring groups of digits, what may stand before and after a run of them, and the digits of one identifier.
_RUN = re.compile(r"(?<![0-9])[0-9]+(?:[\x20().-]{1,3}[0-9]+)+")
_BEFORE = "\x20\t\n\x0b\x0c\r\"'`,;:!?([{<>*#$%&|"
_AFTER = "\x20\t\n\x0b\x0c\r\"'`.,;:!?)]}<>*#$%&|"
RUN_DIGITS = (7, 19)
_EDGE = "\"'`.,;:!?()[]{}<>*#$%&|"


class NotSettled(RuntimeError):
    """The graph of patterns and values still grew after ``MOST_ROUNDS`` turns."""


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if i % 2 == 0 else 2 * x - 9 * (x > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of local part, ``@`` and domain; found from each ``@``.

    A leftmost match starts where the run of local characters before its ``@``
    starts, or where the match before it ended.
    """
    found, after, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        if domain:
            low = at
            while low > after and (c := text[low - 1]).isascii() and (c.isalnum() or c in "._%+-"):
                low -= 1
            if low < at:
                after = domain.end()
                found.append((low, after))
        at = text.find("@", max(at + 1, after))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base matches, sorted; offsets in code points."""
    if not _HINT.search(text):
        return []
    spans = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            spans.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def _fits(kind: int, value: str) -> bool:
    """Whether a value has the least that identifiers of the kind share."""
    return "@" in value if kind == 0 else len(_digits(value)) >= (4, 4, 12, 7)[kind]


def _digit_runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """The digit groups of each run of at least two, from the first that begins to the last that ends as a word does."""
    for m in _RUN.finditer(text):
        groups = [g.span() for g in _GROUP.finditer(text, *m.span())]
        first = next((i for i, (a, _) in enumerate(groups) if a == 0 or text[a - 1] in _BEFORE), len(groups))
        last = next((i for i in range(len(groups) - 1, -1, -1) if groups[i][1] == len(text) or text[groups[i][1]] in _AFTER), -1)
        if last > first:
            yield groups[first:last + 1]


def _run_parts(text: str, groups: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The run, if it has the digits of one identifier; of a longer one its beginnings and ends that have.

    What lies between has no word beside it that a pattern could know. A
    bracket before the first group belongs to it, if one closes in the part.
    """
    start, end = groups[0][0], groups[-1][1]
    sizes = [b - a for a, b in groups]
    found = []
    if sum(sizes) <= RUN_DIGITS[1]:
        found += [(start, end)] * (sum(sizes) >= RUN_DIGITS[0])
    else:
        for order in (range(len(groups)), range(len(groups) - 1, -1, -1)):
            n = 0
            for taken, i in enumerate(order, 1):
                n += sizes[i]
                if n > RUN_DIGITS[1]:
                    break
                if n >= RUN_DIGITS[0] and taken > 1:
                    found.append((start, groups[i][1]) if order.step > 0 else (groups[i][0], end))
    return [(a - (a > 0 and text[a - 1] == "(" and (a == 1 or text[a - 2] in _BEFORE) and ")" in text[a:b]), b) for a, b in found]


class _Context:
    """The words beside places of a text, in time linear in the text.

    Words end at white space and where another place begins or ends. A word
    of more than ``LONG_WORD`` characters stands by its SHA-1.
    """

    def __init__(self, text: str, places: list[tuple]):
        self.text = text
        self.words = [m.span() for m in _WORD.finditer(text)]
        self.word_starts = [a for a, _ in self.words]
        self.place_starts = sorted(a for a, _, _ in places)
        self.place_ends = sorted(b for _, b, _ in places)
        self.whole: dict[int, str] = {}

    @staticmethod
    def plain(word: str) -> str:
        word = word.strip(_EDGE).lower()
        return word if len(word) <= LONG_WORD else "#" + hashlib.sha1(word.encode("utf-8", "surrogatepass")).hexdigest()

    def word(self, i: int) -> str:
        if i not in self.whole:
            self.whole[i] = self.plain(self.text[slice(*self.words[i])])
        return self.whole[i]

    def left(self, a: int) -> list[str]:
        """The two words before ``a``, or as many as there are."""
        i = bisect.bisect_left(self.word_starts, a) - 1  # the word that holds or precedes a
        found = []
        if i >= 0 and self.words[i][1] >= a:
            at = bisect.bisect_right(self.place_ends, a) - 1
            piece = self.text[max(self.words[i][0], self.place_ends[at] if at >= 0 else 0):a].rstrip(_EDGE)
            if piece:
                found.append(self.plain(piece))
            i -= 1
        while i >= 0 and len(found) < 2:
            found.append(self.word(i))
            i -= 1
        return found[::-1]

    def right(self, b: int) -> str:
        """The word after ``b`` and the one character there."""
        i = bisect.bisect_right(self.word_starts, b + 1) - 1  # the word that holds b + 1
        if i >= 0 and self.word_starts[i] < b + 1 < self.words[i][1]:
            at = bisect.bisect_left(self.place_starts, b)
            end = min(self.words[i][1], self.place_starts[at] if at < len(self.place_starts) else len(self.text))
            if piece := self.text[b + 1:end].strip(_EDGE):
                return self.plain(piece)
        i = bisect.bisect_left(self.word_starts, b + 1)
        return self.word(i) if i < len(self.words) else ""


def tokens(text: str, spans: list[tuple[int, int, int]]) -> list[tuple]:
    """(start, end, value, kind or None, patterns) of seeds and other identifier-shaped tokens.

    A run of neighbouring digit groups with the digits of one identifier is a
    candidate as a whole, beside the tokens in it (``_run_parts``).
    """
    places = [(a, b, k) for a, k, b in spans]
    covered, last = [], -1
    for a, b, _ in sorted(places):
        if a >= last:
            covered.append([a, b])
        else:
            covered[-1][1] = max(b, covered[-1][1])
        last = covered[-1][1]
    starts = [a for a, _ in covered]

    def apart(a: int, b: int) -> bool:
        at = bisect.bisect_left(starts, b)
        return at == 0 or covered[at - 1][1] <= a

    low = 0  # no word before this place holds the next hint
    for m in _HINT.finditer(text):
        a, b = m.start(), m.end()
        while a > low and text[a - 1] not in "\x20\t\n\x0b\x0c\r":
            a -= 1
        low = m.end()
        while a < b and text[a] in _EDGE:
            a += 1
        while b > a and text[b - 1] in _EDGE:
            b -= 1
        if b - a >= 5 and apart(a, b) and any(_fits(k, text[a:b]) for k in range(len(KINDS))):
            places.append((a, b, None))
    taken = {(a, b) for a, b, _ in places}
    for groups in _digit_runs(text):
        for part in _run_parts(text, groups):
            if part not in taken and apart(*part):
                taken.add(part)
                places.append((*part, None))
    context, out = _Context(text, places), []
    for a, b, k in places:
        before, right = context.left(a), context.right(b)
        left = before[-1] if before else ""
        patterns = [f"l:{left}", f"r:{right}", f"b:{left} _ {right}"]
        if len(before) == 2:
            patterns.append(f"ll:{' '.join(before)}")
        out.append((a, b, text[a:b].lower(), k, [p for p in patterns if re.search(r"\w", p[p.index(':') + 1:].replace("_", ""))]))
    return out


SCAN = pa.schema([
    ("doc_id", pa.int64()), ("key", pa.int64()), ("base", pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))),
    ("tokens", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("kind", pa.int32()),
                                   ("patterns", pa.list_(pa.string()))]))),
])
SCAN_DDL = ("doc_id long, key long, base array<struct<start:int,kind:int,end:int>>,"
            " tokens array<struct<start:int,end:int,value:string,kind:int,patterns:array<string>>>")


def _scan(batches):
    for rows, texts in text_slices(batches):
        out = []
        for doc_id, key, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), texts.to_pylist(), strict=True):
            spans = base_spans(text)
            out.append({"doc_id": doc_id, "key": key, "base": [dict(zip(("start", "kind", "end"), s, strict=True)) for s in spans],
                        "tokens": [dict(zip(("start", "end", "value", "kind", "patterns"), t, strict=True)) for t in tokens(text, spans)]})
        yield pa.RecordBatch.from_pylist(out, SCAN)


def scan(docs: DataFrame) -> DataFrame:
    """One stored row per document: hash of its text, base spans, tokens with their patterns."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    found = rows.mapInArrow(_scan, SCAN_DDL)
    return save(found.withColumn("row", F.monotonically_increasing_id()), "pii-scan")


def occurrences(scanned: DataFrame) -> DataFrame:
    return scanned.select("row", F.explode("tokens").alias("t")).select("row", "t.*")


def _fits_kind(kind: Column, value: Column) -> Column:
    n = F.length(F.regexp_replace(value, "[^0-9]", ""))
    least = F.element_at(F.array(*[F.lit(x) for x in (4, 4, 12, 7)]), kind + 1)
    return F.when(kind == 0, F.contains(value, F.lit("@"))).otherwise(n >= least)


def bootstrap(found: DataFrame, rounds: int = MOST_ROUNDS, support: int = SUPPORT,
              pattern_confidence: float = PATTERN_CONFIDENCE, value_score: float = VALUE_SCORE) -> DataFrame:
    """(value, kind, score) of the seeds and of the unseen values that confident patterns find.

    ``found`` has value, kind (null if unseen) and patterns. Edges are made
    distinct first, so a value repeated in a third of the rows is one row. More
    known values never lower a confidence or a score, so the values only grow, and
    turns go on until none is added; ``NotSettled`` if ``rounds`` are too few.
    """
    edges = save(found.select("value", F.explode("patterns").alias("pattern")).distinct(), "pii-edges")
    known = save(found.where("kind is not null").select("value", "kind").distinct().withColumn("score", F.lit(1.0)), "pii-seeds")
    seeds = known
    totals = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    size = known.count()
    for turn in range(rounds):
        evidence = (edges.join(known, "value").groupBy("pattern", "kind")
                    .agg(F.sum("score").alias("score"), F.count("*").alias("support")).where(F.col("support") >= support))
        confident = (evidence.join(totals, "pattern").withColumn("confidence", F.col("score") / (F.col("n") + 1))
                     .where(F.col("confidence") >= pattern_confidence).select("pattern", "kind", "confidence"))
        scored = (edges.join(confident, "pattern").groupBy("value", "kind")
                  .agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("score"))
                  .where((F.col("score") >= value_score) & _fits_kind(F.col("kind"), F.col("value"))))
        new = scored.join(seeds.select("value").distinct(), "value", "left_anti")
        known, before = save(seeds.unionByName(new), f"pii-known-{turn}"), size
        size = known.count()
        if size == before:
            return known
    raise NotSettled(f"values are still added after {rounds} turns")


def find_spans(docs: DataFrame, rounds: int = MOST_ROUNDS, support: int = SUPPORT, pattern_confidence: float = PATTERN_CONFIDENCE,
               value_score: float = VALUE_SCORE) -> DataFrame:
    """Every document's ``base`` and ``extra`` spans: arrays of (start, kind, end).

    ``docs`` needs doc_id and text; other columns are ignored. A null or empty
    text has no spans. Repeated rows are scanned each for itself; each value
    counts once as evidence, however often it is repeated. A token that equals
    a seed found elsewhere counts as found, too. Of found spans within each other the outer counts. Of a value found for two kinds the better scored counts, ties the earlier kind. An empty
    table gives no rows. The text is read once and not shuffled.
    """
    scanned = scan(docs)
    found = occurrences(scanned)
    known = bootstrap(found, rounds, support, pattern_confidence, value_score)
    best = known.groupBy("value").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"))
    before = Window.partitionBy("row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    extra = (found.where("kind is null").drop("kind").join(best, "value").withColumn("reach", F.max("end").over(before))
             .where("reach is null or end > reach").groupBy("row")
             .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("extra")))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return scanned.join(extra, "row", "left").select("doc_id", "key", "base", F.coalesce("extra", empty).alias("extra"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def count_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span (overlapping ones as one) replaced by its kind in brackets."""
    out, at = [], 0
    for a, k, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with the spans of ``find_spans`` masked in ``text`` and ``n_chars`` counted anew.

    Base spans are found again where the text is; only documents with unseen
    identifiers meet their extra spans, by doc_id and a hash of the text. A
    null text stays null, an empty one empty; a null doc_id is an id of its
    own; repeated rows are masked each. All other columns stay, whatever their
    names. An empty table gives no rows.
    """
    spans = find_spans(docs, **settings)
    doc, key, more = free_names(docs, "doc", "key", "extra")
    extra = (spans.where(F.size("extra") > 0).groupBy(F.col("doc_id").alias(doc), F.col("key").alias(key))
             .agg(F.first("extra").alias(more)))
    schema = docs.schema
    names = docs.columns
    joined = docs.join(extra, docs["doc_id"].eqNullSafe(extra[doc]) & (F.xxhash64(docs["text"]) == extra[key]), "left").drop(doc, key)

    def run(batches):
        at_text, at_chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None
        for batch, _ in text_slices(batches):
            texts, extras = batch.column(at_text).to_pylist(), batch.column(len(names)).to_pylist()
            new = [t if t is None else mask(t, base_spans(t) + [(s["start"], s["kind"], s["end"]) for s in e or []])
                   for t, e in zip(texts, extras, strict=True)]
            cols = [batch.column(i) for i in range(len(names))]
            cols[at_text] = pa.array(new, batch.schema.field(at_text).type)
            if at_chars is not None:
                cols[at_chars] = pa.array([c if t is None else len(t) for t, c in zip(new, cols[at_chars].to_pylist(), strict=True)],
                                          batch.schema.field(at_chars).type)
            yield pa.RecordBatch.from_arrays(cols, names)

    return joined.mapInArrow(run, schema)
