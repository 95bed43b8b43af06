"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of words without their outer punctuation, in lower
case. Numbers, names and units are *slots*: a typed placeholder stands in the
template for a run of number or of name words (Anna Maria, twenty five), the
slot keeps its value. A name is a capitalised word other than a common one; a
word of capitals alone is shouting, not a name.

Texts meet by hashed windows of ``WINDOW`` words at least, each a key:

- *literal* windows: the words themselves, whatever their case; an item with
  fewer words than ``WINDOW`` has one, of all its words;
- *template* windows: tokens with placeholders, long enough to hold
  ``LITERALS`` plain words, reached forwards and backwards. Capitalised words
  that open a sentence are names in one reading and plain words in another; an
  item has a third one without names, for copies in lower case.

For a document and an item the matching windows form alignments: those on one
diagonal (document place minus item place), and those on diagonals that lie
within ``DRIFT`` of the item's words, so that inserted and deleted words don't
split a copy. Every place of the item belongs to one diagonal, that with most
windows first. An alignment marks the document if it is

- a copy: at least as many slots are equal as changed, and the literally equal
  words cover ``COVERAGE`` of the item's words. ``LITERALS`` of these are plain
  words, or it is the whole item;
- a re-parameterised question: one value of the item always stands for one
  value of the document, ``COVERAGE`` of the item's words are covered,
  ``PLAIN`` of these are plain words, and there are two windows or the whole
  item;
- an item under ``WINDOW`` words with ``SHORT_PLAIN`` plain words, or one that
  is all of the document.

Other alignments are reported, but don't mark.

The item windows are broadcast while they are at most ``BROADCAST_WINDOWS``
(8 bytes each); beyond that all document windows are joined by a shuffle, with
the same result.

Defined results: null or empty texts have no windows; null ids are kept;
repeated rows are reported once each way (a row's content is its identity);
items without words match nothing; an empty table gives an empty one; other
columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import free_name, row_key, utf8

WINDOW = 8
LITERALS = 4
COVERAGE = 0.5
DRIFT = 0.5
PLAIN = 5
SHORT_PLAIN = 2
ENTRIES = 250_000
TOGETHER = 200_000  #: bytes of text read at once, or one text
BROADCAST_WINDOWS = 2_000_000

EDGE = b".,;:!?\"'()[]{}<>*#&|~`=^_"
ENDS = (b".", b"!", b"?", b".\"", b".)", b"!\"", b"?\"", b":")
NUMBER = re.compile(rb"[+-]?[$]?\d+(?:[.,:/]\d+)*")
QUANTITY = re.compile(rb"[+-]?\d+(?:[.,]\d+)*([a-z%]+)")
UNITS = set(b"""mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds
ounce ounces oz ton tons ml l liter liters litre litres gallon gallons second seconds sec minute minutes min hour hours hr day days week weeks
month months year years percent % dollar dollars cent cents euro euros km/h mph degree degrees volt volts watt watts joule joules newton newtons
hz khz mhz ghz kb mb gb tb""".split())
SPELLED = set(b"""two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty
thirty forty fifty sixty seventy eighty ninety hundred thousand million billion""".split())

#: Words that are no names even if capitalised.
COMMON = set("""a about after all also although an and another any are as at be because before below both but by can compute consider calculate choose complete could
describe determine did do does during each either estimate evaluate every explain express few find first for from give given had has have he hence her here his how
however i if in into is it its just last let like many more most much my name near no nor not now of often on once one only or other our over per please prove select
she should show simplify since so solve some state such suppose than that the their them then there therefore these they this those though through thus to together
two under until up upon us use using was we were what when where whether which while who whose why with within without would write yes you your
der die das ein eine einen einem einer und oder aber wenn dann wie was wer wo warum wann welche welcher welches ist sind war im in am an auf aus bei mit nach von vor zu
zum zur es er sie wir ihr ich nicht auch für berechne bestimme finde gib le la les un une des du de et ou mais si quand comment que qui quoi pourquoi quel quelle quels
quelles est sont il elle ils elles nous vous je dans en sur avec pour par ne pas ce cette ces calculez trouvez el los las unos unas y o pero cuando como qué quién cuál
cuántos cuántas es son era él ella ellos ellas no se lo con para por del al una calcula encuentra""".split())

LITERAL, NUM, QTY, UNIT, NAME = range(5)
BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def word_value(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data, 7)


#: Kinds of the words that a list tells.
LISTED = dict.fromkeys((w.encode() for w in COMMON), LITERAL) | dict.fromkeys(UNITS, UNIT) | dict.fromkeys(SPELLED, NUM)
ENDING, FOLLOWED, PRECEDED = 8, 16, 32


def read_word(word: bytes) -> tuple[int, int]:
    """(value, flags): the kind, whether it ends a sentence, whether marks follow and precede it."""
    core = word.strip(EDGE)
    shown = core if core.isascii() else core.decode("utf-8", "replace")
    low = core.lower() if shown is core else shown.lower().encode()
    kind = LISTED.get(low)
    if kind is None:
        if core[:1] in b"+-$0123456789" and core:
            kind = NUM if NUMBER.fullmatch(core) else QTY if (m := QUANTITY.fullmatch(low)) and m[1] in UNITS else LITERAL
        elif b"-" in low and all(p in SPELLED or p == b"one" for p in low.split(b"-")):
            kind = NUM
        else:
            kind = NAME if shown[:1].isupper() and (len(shown) == 1 or not shown.isupper()) else LITERAL
    if len(core) < len(word):
        kind |= ENDING * word.endswith(ENDS) | FOLLOWED * (word[-1:] in EDGE) | PRECEDED * (word[:1] in EDGE)
    return word_value(low), kind


@dataclass
class Words:
    value: np.ndarray
    kind: np.ndarray
    opens: np.ndarray  # the word is a sentence's first
    joined: np.ndarray  # no marks between the word and the one before it
    text: np.ndarray  # number of the text that the word is in
    begin: np.ndarray  # first word of each text, and the number of words


class Lexicon(dict):
    """Number of every word met, with what ``read_word`` says of it in arrays.
    It starts again between texts when it has ``ENTRIES``; long words are not
    kept, so memory stays bounded and results never change."""

    def __init__(self):
        super().__init__()
        self.value, self.flags = array("Q"), array("B")

    def __missing__(self, word: bytes) -> int:
        i = len(self.value)
        value, flags = read_word(word)
        self.value.append(value)
        self.flags.append(flags)
        if len(word) <= 64:
            self[word] = i
        return i

    def parse(self, texts: list[bytes]) -> Words:
        """The words of some texts, one after the other."""
        if len(self.value) >= ENTRIES:
            self.clear()
            self.value, self.flags = array("Q"), array("B")
        split = [text.split() for text in texts]
        sizes = np.array([len(words) for words in split], np.int64)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        at = np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.int64, begin[-1])
        flags = np.frombuffer(self.flags, np.uint8)[at] if len(at) else np.zeros(0, np.uint8)
        opens, joined, starts = np.ones(len(at), bool), np.zeros(len(at), bool), begin[:-1][sizes > 0]
        opens[1:] = flags[:-1] & ENDING
        joined[1:] = (flags[:-1] & FOLLOWED) + (flags[1:] & PRECEDED) == 0
        opens[starts], joined[starts] = True, False
        value = np.frombuffer(self.value, np.uint64)[at] if len(at) else np.zeros(0, np.uint64)
        return Words(value, (flags & 7).astype(np.int64), opens, joined, np.repeat(np.arange(len(texts)), sizes), begin)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 up to n."""
    if not _POWERS or len(_POWERS[0]) <= n:
        _POWERS.clear()
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            table = np.full(max(n, 1 << 15) + 1, base, np.uint64)
            table[0] = 1
            _POWERS.append(np.multiply.accumulate(table))
    return _POWERS[0], _POWERS[1]


def window_keys(token: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A key for each window of tokens (polynomial hashes by prefix sums)."""
    up, down = powers(len(token))
    prefix = np.zeros(len(token) + 1, np.uint64)
    np.cumsum(token * up[:len(token)], out=prefix[1:])
    h = (prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


@dataclass
class Windows:
    key: np.ndarray
    at: np.ndarray  # first word
    to: np.ndarray  # word after the last one
    first: np.ndarray  # tokens
    end: np.ndarray
    kind: np.ndarray  # of every token
    value: np.ndarray
    begin: np.ndarray  # first word of every token, and the number of words
    width: int  # least tokens

    def slots(self, i: int) -> np.ndarray:
        return np.flatnonzero(self.kind[self.first[i]:self.end[i]] != LITERAL) + self.first[i]


def literal_windows(words: Words, width: int) -> Windows:
    n = len(words.value)
    first = np.arange(max(0, n - width + 1))
    first = first[words.text[first] == words.text[first + width - 1]]
    return Windows(window_keys(words.value, first, first + width), first, first + width, first, first + width, np.zeros(n, np.int64), words.value, np.arange(n + 1), width)


def template_windows(words: Words, kind: np.ndarray, width: int | None = None) -> Windows:
    """Windows of at least ``width`` tokens (None: ``WINDOW``, or all if there
    are fewer) that hold a slot. ``kind``: one reading of the words."""
    run = words.joined & ((kind == NAME) | (kind == NUM))
    run[1:] &= kind[1:] == kind[:-1]
    value = words.value
    begin = np.arange(len(kind) + 1)
    if run.any():
        starts = np.flatnonzero(~run)
        begin = np.append(starts, len(kind))
        place = np.arange(len(kind)) - np.repeat(starts, np.diff(begin))
        value, kind = np.add.reduceat(value * (2 * place + 1).astype(np.uint64), starts), kind[starts]
    n, plain = len(kind), kind == LITERAL
    width = min(WINDOW, n) if width is None else width
    places = np.flatnonzero(plain)
    before = np.concatenate([[0], np.cumsum(plain)])
    none = np.zeros(0, np.int64)
    first, end, back = none, none, none
    if n >= width and len(places) >= LITERALS:
        first = np.arange(n - width + 1)
        first = first[before[first] + LITERALS <= len(places)]
        end = np.maximum(first + width, places[before[first] + LITERALS - 1] + 1)
        back = np.arange(width, n + 1)  # ends of windows that lack plain words are reached backwards
        back = back[(before[back] - before[back - width] < LITERALS) & (before[back] >= LITERALS)]
        first, end = np.concatenate([first, places[before[back] - LITERALS]]), np.concatenate([end, back])
        some = (before[end] - before[first] < end - first) & (words.text[begin[first]] == words.text[begin[end - 1]])
        first, end = first[some], end[some]
    token = np.where(plain, value, (kind + 1).astype(np.uint64) * np.uint64(BASE))
    return Windows(window_keys(token, first, end), begin[first], begin[end], first, end, kind, value, begin, width)


def readings(words: Words, item: bool) -> list[np.ndarray]:
    """Kinds with sentence openers as names and as plain words; of an item, also without names."""
    name = words.kind == NAME
    out = [words.kind]
    if (name & words.opens).any():
        out.append(np.where(name & words.opens, LITERAL, words.kind))
    if item and name.any():
        out.append(np.where(name, LITERAL, words.kind))
    return out


ITEM_WINDOWS = pa.schema([("key", pa.int64()), ("item_id", pa.int64()), ("item", pa.int64()), ("words", pa.int32()), ("template", pa.bool_()), ("width", pa.int32()), ("at", pa.int32()), ("to", pa.int32()),
                          ("slots", pa.list_(pa.int64())), ("slot_at", pa.list_(pa.int32())), ("slot_to", pa.list_(pa.int32())), ("marked", pa.list_(pa.int32()))])


def item_windows(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Every window of every item. ``width``: the least tokens of its kind of
    windows, under ``WINDOW`` if the item has no more; ``slots``: their values, ``slot_at`` and
    ``slot_to`` their words; ``marked``: the words that aren't plain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon()
        for batch in batches:
            rows = []
            for name, item, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
                words = lexicon.parse([data])
                n, seen = len(words.value), set()
                made = [literal_windows(words, min(WINDOW, n))] if n else []
                made += [template_windows(words, kind) for kind in readings(words, True)] if n >= WINDOW else []
                for form, w in enumerate(made):
                    for i, key in enumerate(w.key.view(np.int64).tolist()):
                        at, to = int(w.at[i]), int(w.to[i])
                        if (key, at, to) not in seen:
                            seen.add((key, at, to))
                            s = w.slots(i)
                            rows.append({"key": key, "item_id": name, "item": item, "words": n, "template": form > 0, "width": w.width, "at": at, "to": to, "slots": w.value[s].view(np.int64).tolist(),
                                         "slot_at": w.begin[s].tolist(), "slot_to": w.begin[s + 1].tolist(), "marked": (np.flatnonzero(words.kind[at:to] != LITERAL) + at).tolist()})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, ITEM_WINDOWS)

    return items.select(F.col(item_id).cast("long").alias("item_id"), row_key(item_id, text).alias("item"), F.col(text).alias("text")).distinct().mapInArrow(
        run, "key long, item_id long, item long, words int, template boolean, width int, at int, to int, slots array<long>, slot_at array<int>, slot_to array<int>, marked array<int>")


def document_windows(docs: DataFrame, doc_id: str, text: str, forms: list[tuple[bool, int]], wanted) -> DataFrame:
    """(rid, doc_id, length, key, width, place, doc_slots); ``wanted``: a broadcast
    sorted array of keys, or None for all windows. Of equal literal
    windows shorter than ``WINDOW`` a document gives the first."""
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("length", pa.int32()), ("key", pa.int64()), ("width", pa.int32()), ("place", pa.int32()), ("doc_slots", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, keys = Lexicon(), None if wanted is None else wanted.value
        if keys is not None:  # most windows are settled by a table of the keys' low bits
            low = np.uint64((1 << max(16, (32 * len(keys)).bit_length())) - 1)
            table = np.zeros(int(low) + 1, bool)
            table[keys & low] = True
        for batch in batches:
            if not batch.num_rows:
                continue
            rid, name, texts = batch.column(0).to_numpy(), batch.column(1), utf8(batch.column(2))
            sizes = np.cumsum([len(data) for data in texts]) // TOGETHER
            for row in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(sizes)) + 1):
                words = lexicon.parse([texts[i] for i in row])
                read = readings(words, False)
                for template, w in ((template, w) for template, width in forms for w in ([template_windows(words, kind, width) for kind in read] if template else [literal_windows(words, width)])):
                    found = w.key
                    if keys is None:
                        hit = np.arange(len(found))
                    else:
                        hit = np.flatnonzero(table[found & low])
                        hit = hit[keys[np.minimum(np.searchsorted(keys, found[hit]), len(keys) - 1)] == found[hit]]
                    if not template and w.width < WINDOW:
                        once = np.stack([words.text[w.at[hit]].astype(np.uint64), found[hit]])
                        hit = hit[np.sort(np.unique(once, axis=1, return_index=True)[1])]
                    for part in np.array_split(hit, max(1, len(hit) // 50_000)) if len(hit) else []:
                        slots = [[]] * len(part) if not template else [w.value[w.slots(i)].view(np.int64).tolist() for i in part.tolist()]
                        of = words.text[w.at[part]]
                        yield pa.RecordBatch.from_arrays([pa.array(rid[row[of]]), name.take(pa.array(row[of])), pa.array(np.diff(words.begin)[of].astype(np.int32)), pa.array(found[part].view(np.int64)),
                                                          pa.array(np.full(len(part), w.width, np.int32)), pa.array((w.at[part] - words.begin[of]).astype(np.int32)), pa.array(slots, pa.list_(pa.int64()))], schema=schema)

    return docs.select(row_key(doc_id, text).alias("rid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "rid long, doc_id long, length int, key long, width int, place int, doc_slots array<long>")


HIT = ["place", "at", "to", "slots", "slot_at", "slot_to", "doc_slots", "marked"]
RATED = {"begin": pa.int32(), "windows": pa.int32(), "covered": pa.int32(), "coverage": pa.float64(), "slots": pa.int64(), "changed": pa.int64(), "consistent": pa.bool_(), "contaminated": pa.bool_()}


def rate(words: int, length: int, diagonals: list[list[tuple]], coverage: float) -> tuple:
    """The values of ``RATED`` for the alignment that the hits on some diagonals make."""
    owner: dict[int, int] = {}
    met: dict[tuple[int, int], tuple[int, int]] = {}
    marked, starts = set(), set()
    for d, hits in enumerate(sorted(diagonals, key=lambda h: (-len(h), h[0][0]))):
        for _, at, to, slots, slot_at, slot_to, doc_slots, kinds in hits:
            starts.add(at)
            marked.update(kinds)
            for place in range(at, to):
                owner.setdefault(place, d)
            for was, now, a, b in zip(slots, doc_slots, slot_at, slot_to, strict=True):
                if owner[a] == d:
                    met[a, b] = was, now
    stands: dict[int, set[int]] = {}
    for was, now in met.values():
        stands.setdefault(was, set()).add(now)
    moved = [span for span, (was, now) in met.items() if was != now]
    consistent = all(len(x) == 1 for x in stands.values())
    equal = owner.keys() - {place for a, b in moved for place in range(a, b)}
    covered = len(owner)
    begin = min(h[0] for hits in diagonals for h in hits)
    plain = owner.keys() - marked
    if words < WINDOW:
        contaminated = len(plain) >= SHORT_PLAIN or length == words
    elif 2 * len(moved) <= len(met) and len(equal) >= coverage * words and (len(equal & plain) >= LITERALS or len(equal) == words):
        contaminated = True
    else:
        contaminated = bool(moved) and consistent and covered >= coverage * words and len(plain) >= PLAIN and (len(starts) > 1 or covered == words)
    return begin, len(starts), covered, covered / words, len(stands), sum(x != {was} for was, x in stands.items()), consistent, contaminated


def best_alignment(words: int, length: int, hits: list[tuple], coverage: float) -> tuple:
    by: dict[int, list[tuple]] = {}
    for hit in hits:
        by.setdefault(hit[0] - hit[1], []).append(hit)
    order, drift, end = sorted(by), max(1, int(DRIFT * words)), 0
    tried = [[by[d]] for d in order]
    for i, d in enumerate(order):
        to = bisect_right(order, d + drift)
        if to > max(end, i + 1):
            tried.append([by[x] for x in order[i:to]])
        end = to
    return max((rate(words, length, t, coverage) for t in tried), key=lambda r: (r[7], r[3], r[6], -r[5], -r[0]))


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
               coverage: float = COVERAGE, most_broadcast: int = BROADCAST_WINDOWS) -> DataFrame:
    """(rid, doc_id, item_id, begin, windows, covered, coverage, slots, changed,
    consistent, contaminated) for the best alignment of every document and item
    that share a window. ``rid`` is the key of the row's content."""
    spark = docs.sparkSession
    windows = item_windows(items, item_id, text).checkpoint()
    keys = windows.select("key").distinct()
    forms = sorted((r.template, r.width) for r in windows.select("template", "width").distinct().collect())  # at most 2 * WINDOW
    wanted = None
    if keys.count() <= most_broadcast:
        sorted_keys = np.sort(np.array([r.key for r in keys.collect()], np.int64).view(np.uint64))
        wanted = spark.sparkContext.broadcast(sorted_keys if len(sorted_keys) else np.zeros(1, np.uint64))
    hits = (document_windows(docs, doc_id, text, forms, wanted).join(windows, ["key", "width"])
            .where(F.size("slots") == F.size("doc_slots")).dropDuplicates(["rid", "item", "key", "place", "at", "to"]))
    head = ["rid", "item", "doc_id", "item_id", "words", "length"]
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("item_id", pa.int64()), *RATED.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        made = []
        for (rid, _), group in groupby(rows, key=lambda row: row[:2]):
            group = list(group)
            _, _, doc, item, words, length = group[0][:6]
            made.append((rid, doc, item, *best_alignment(words, length, [row[6:] for row in group], coverage)))
            if len(made) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made, strict=True), schema.types, strict=True)], schema=schema)
                made = []
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made, strict=True), schema.types, strict=True)], schema=schema)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (hits.select(*head, *HIT).repartition(parts, "rid", "item").sortWithinPartitions("rid", "item", "place", "at").mapInArrow(
        run, "rid long, doc_id long, item_id long, begin int, windows int, covered int, coverage double, slots long, changed long, consistent boolean, contaminated boolean"))


def without_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated rows; all columns are kept."""
    own = free_name(docs, "_rid")
    bad = find_leaks(docs, items, doc_id, text=text, **options).where("contaminated").select(F.col("rid").alias(own)).distinct()
    return docs.withColumn(own, row_key(doc_id, text)).join(bad, own, "left_anti").drop(own)
