"""Benchmark decontamination by templates: the same question with other numbers, names or units.

Texts become templates: numbers, names and units give way to placeholders of their type, a run of names
or of numbers to one.  Whether a word with a capital is a name cannot be told for sure, so a text is read
in several ways, among them word by word, and the windows of all readings are joined by hash with those of the
benchmark.  Windows of a document that follow an item nearly in step must fill its slots consistently, each
value of the item by one value of the document.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType

from tablemill.llm.anchors import gram_hashes, mixed, word_hashes
from tablemill.llm.arrow_text import bounds, numbered, raw_bytes, slices, word_places, words
from tablemill.llm.minhash import keep_keys
from tablemill.llm.repeats import BYTE_HASH, NO_ID, keyed
from tablemill.llm.staged import stage

WINDOW = 8
# Items of fewer tokens than a window are matched whole, down to this many.
SHORTEST = 5
LEAST_SHARE = 0.8
# Neighbouring steps of one copy of an item are at most so many tokens apart: words put in or left out.
GAP = 3
BLOCK = 1_000_000

UNITS = set(
    "mm cm dm m km inch inches foot feet ft yard yards mile miles mg g kg t ton tons tonne tonnes oz ounce ounces lb lbs pound pounds "
    "ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years cent cents dollar dollars euro euros usd eur percent degree degrees mph kph".split()
)
NUMBER = re.compile(r"[+-]?\d[\d.,:/]*(?:st|nd|rd|th)?")
WITH_UNIT = re.compile(r"([+-]?\d(?:[\d.,:/]*\d)?)([^\W\d_]+)")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
# Words that are no names, wherever they stand and however they are written.
NO_NAMES = set(
    "a an the this that these those what which who whom whose when where why how if then than and or but so as at by for from in into of "
    "on to with without after before during while until since because although though however there here it its he she they we you i his "
    "her their our your my him them us me is are was were be been do does did has have had can could will would shall should may might must "
    "not no yes each every all some any both one two let find given suppose assume calculate compute determine".split()
)
LITERAL, NUMBER_SLOT, UNIT_SLOT, NAME_SLOT = range(4)
PLACEHOLDERS = mixed(np.arange(77, 81, dtype=np.uint64))
SLOT_NAMES = ("", "number", "unit", "name")
# Readings: word by word; no word a name; names inside sentences only; of the capitals that open a sentence all,
# or every other one, as well.  So a window with two such capitals has every combination of kinds.
WORDS, NO_CAPITALS, INSIDE, OPENERS, EVEN, ODD = range(6)

WINDOWS = "at int, until int, key long, slots array<string>"


# Words of letters a to z with at most a mark behind, which are most words, are told of as arrays.
PLAIN = r"^[A-Za-z]+[.,:;!?]?$"


def plain_words(found: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The forms, kinds and capitals of plain words, and whether they end a sentence, or a run of names or numbers."""
    def told(mask: pa.Array) -> np.ndarray:
        return mask.to_numpy(zero_copy_only=False)

    bare = pc.ascii_rtrim(found, ".,:;!?")
    form = pc.ascii_lower(bare)
    kinds = np.where(told(pc.is_in(form, pa.array(sorted(UNITS)))), np.int8(UNIT_SLOT), np.int8(LITERAL))
    # a capital first and a small letter behind
    named = told(pc.match_substring_regex(bare, "^[A-Z].*[a-z]")) & ~told(pc.is_in(form, pa.array(sorted(NO_NAMES))))
    closes = told(pc.match_substring_regex(found, "[.:;!?]$"))
    return form, kinds, named, closes, closes | told(pc.ends_with(found, ","))


class Templates:
    """The tokens of a batch of texts and their templates in each reading.

    Places are counted in tokens of the reading INSIDE, whatever the reading of a window.
    """

    def __init__(self, texts: pa.Array):
        counts, flat = words(texts)
        raw, starts = raw_bytes(texts)
        begins, ends, first = word_places(raw, starts)
        ids, distinct = numbered(flat)
        # a word is one token, or two if it is a number with its unit; words without letters and digits are none
        plain = pc.match_substring_regex(distinct, PLAIN).to_numpy(zero_copy_only=False)
        forms, kinds, capital, closes, ends_run = plain_words(distinct.filter(pa.array(plain)))
        token_from, n_forms = np.zeros(len(distinct), np.int64), plain.astype(np.int64)
        token_from[plain] = np.arange(len(forms))
        closing, run_ending = np.zeros(len(distinct), bool), np.zeros(len(distinct), bool)
        closing[plain], run_ending[plain] = closes, ends_run
        others = np.nonzero(~plain)[0]
        more_forms, more_kinds, more_capital = [], [], []
        for at, word in zip(others.tolist(), distinct.filter(pa.array(~plain)).to_pylist()):
            bare = EDGES.sub("", word)
            form = bare.lower()
            joined = WITH_UNIT.fullmatch(form)
            token_from[at] = len(forms) + len(more_forms)
            if joined and joined[2] in UNITS:
                more_forms += joined.groups()
                more_kinds += [NUMBER_SLOT, UNIT_SLOT]
                more_capital += [False, False]
            elif form:
                more_forms.append(form)
                more_kinds.append(NUMBER_SLOT if NUMBER.fullmatch(bare) else UNIT_SLOT if form in UNITS else LITERAL)
                more_capital.append(len(bare) > 1 and bare[0].isupper() and not bare.isupper() and form not in NO_NAMES)
            n_forms[at] = len(forms) + len(more_forms) - token_from[at]
            end = word.rstrip("\"')]»”’")[-1:]
            closing[at] = end in tuple(".!?:;")
            run_ending[at] = end in tuple(".!?:;,")
        forms = pa.concat_arrays([forms, pa.array(more_forms, pa.string())])
        kinds = np.concatenate([kinds, np.array(more_kinds, np.int8)])
        capital = np.concatenate([capital, np.array(more_capital, bool)])
        form_raw, form_starts = raw_bytes(forms)
        hashes = word_hashes(form_raw, form_starts[:-1], form_starts[1:], BYTE_HASH) if len(forms) else np.zeros(0, np.uint64)
        # a sentence, a line or the text begins at a word, or a run of names or numbers cannot go on with it
        opens, breaks = np.ones(len(ids), bool), np.ones(len(ids), bool)
        if len(ids) > 1:
            lines = np.concatenate([[0], np.cumsum(raw == 10)])
            new_line = lines[begins[1:]] > lines[ends[:-1]]
            opens[1:] = closing[ids[:-1]] | new_line
            breaks[1:] = run_ending[ids[:-1]] | new_line
        opens[first[:-1][np.diff(first) > 0]] = True
        breaks[first[:-1][np.diff(first) > 0]] = True
        n_tokens = n_forms[ids]
        each = np.repeat(np.arange(len(ids)), n_tokens)
        part = np.arange(len(each)) - np.repeat(np.cumsum(n_tokens) - n_tokens, n_tokens)
        self.forms, self.ids = forms, token_from[ids[each]] + part
        # a word without letters that ends a run ends it also for the token after it
        breaks_before = np.cumsum(breaks)[each]
        self.breaks = np.ones(len(each), bool)
        self.breaks[1:] = breaks_before[1:] > breaks_before[:-1]
        row = np.repeat(np.arange(len(counts)), counts)[each]
        self.bounds = bounds(np.bincount(row, minlength=len(counts)))
        self.literal = hashes[self.ids]
        kind = kinds[self.ids]
        named = capital[self.ids] & (kind == LITERAL)
        opener = named & opens[each]
        second = np.cumsum(opener) % 2 == 1
        self.kinds = [np.zeros(len(kind), np.int8)]
        for names in (np.zeros(len(kind), bool), named & ~opener, named, named & ~(opener & second), named & ~(opener & ~second)):
            self.kinds.append(np.where(names, np.int8(NAME_SLOT), kind))
        # where the tokens of each reading begin
        self.heads = [np.nonzero(self.runs(kind))[0] for kind in self.kinds]
        self.place = np.cumsum(self.runs(self.kinds[INSIDE])) - 1
        base = np.append(self.place, self.place[-1:] + 1)[self.bounds] if len(row) else np.zeros(len(counts) + 1, np.int64)
        self.base, self.sizes = base[:-1], np.diff(base)

    def runs(self, kind: np.ndarray) -> np.ndarray:
        heads = np.ones(len(kind), bool)
        heads[1:] = (kind[1:] != kind[:-1]) | ((kind[1:] != NAME_SLOT) & (kind[1:] != NUMBER_SLOT)) | self.breaks[1:]
        return heads

    def windows(self, reading: int, width: int, wanted: tuple[np.ndarray, np.ndarray] | None) -> list[tuple[int, int, int, int]]:
        """(row, first token, end, key) of the windows of ``width`` tokens within a text that are wanted.

        ``wanted`` holds sorted keys and their ``leading_bits``; without it all windows are given that are full, or a whole text.  A
        window with fewer than half of its tokens literal says too little as a template and is left to the
        reading by words.
        """
        heads, kind = self.heads[reading], self.kinds[reading]
        n = len(heads) - width + 1
        if n <= 0 or wanted is not None and not len(wanted[0]):
            return []
        of_head = kind[heads]
        if reading == WORDS:
            key = mixed(gram_hashes(self.literal, width) ^ np.uint64(width + 1000))
            some = np.ones(n, bool)
        else:
            template = np.where(of_head == LITERAL, self.literal[heads], PLACEHOLDERS[of_head])
            key = mixed(gram_hashes(template, width) ^ np.uint64(width))
            literal = np.concatenate([[0], np.cumsum(of_head == LITERAL)])
            some = 2 * (literal[width:] - literal[:-width]) >= width
        if wanted is not None:
            # most keys are ruled out by their leading bits
            known, bits = wanted
            at = np.nonzero(some & bits[key >> np.uint64(64 - len(bits).bit_length() + 1)])[0]
            at = at[known[np.minimum(np.searchsorted(known, key[at]), len(known) - 1)] == key[at]]
        else:
            at = np.nonzero(some)[0]
        row = np.searchsorted(self.bounds, heads[at], "right") - 1
        ends = np.append(heads, len(kind))[at + width]
        inside = ends <= self.bounds[row + 1]
        if wanted is None and width < WINDOW:
            inside &= (heads[at] == self.bounds[row]) & (ends == self.bounds[row + 1])
        at, row, ends = at[inside], row[inside], ends[inside]
        return list(zip(row.tolist(), heads[at].tolist(), ends.tolist(), key[at].view(np.int64).tolist()))

    def slots(self, reading: int, begin: int, end: int) -> list[str]:
        """The fillings of a window's slots; those of the reading by words are numbers and units, told by their spelling."""
        out: list[str] = []
        kinds = self.kinds[reading] if reading != WORDS else self.kinds[NO_CAPITALS]
        for i in range(begin, end):
            if kinds[i] == LITERAL:
                continue
            form = self.forms[int(self.ids[i])].as_py()
            goes_on = i > begin and kinds[i] == kinds[i - 1] and kinds[i] in (NAME_SLOT, NUMBER_SLOT) and not self.breaks[i]
            if goes_on:
                out[-1] += form if kinds[i] == NUMBER_SLOT else f" {form}"
            else:
                out.append(f"{SLOT_NAMES[kinds[i]]}:{form}")
        return out


def leading_bits(keys: np.ndarray) -> np.ndarray:
    """Which leading bits the keys have, at a few times as many places as keys."""
    width = min(24, max(10, len(keys).bit_length() + 4))
    out = np.zeros(1 << width, bool)
    out[keys >> np.uint64(64 - width)] = True
    return out


def template_windows(wanted: dict[int, np.ndarray] | None):
    """A task that gives the windows of each row; ``wanted`` holds the widths and sorted keys to look for.

    Without it the rows are benchmark items: each gives its windows, or itself as one if it is shorter.
    """
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        looked_for = None if wanted is None else {width: (keys, leading_bits(keys)) for width, keys in wanted.items()}
        for part in slices(batches, "text"):
            found = Templates(part.column("text"))
            taken: dict[tuple[int, int, int, int, int], int] = {}
            for width in range(SHORTEST, WINDOW + 1) if wanted is None else wanted:
                for reading in range(WORDS, ODD + 1):
                    for one in found.windows(reading, width, None if looked_for is None else looked_for[width]):
                        taken.setdefault((*one, width), reading)
            row = [one[0] for one in taken]
            rows_ = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    **{name: part.column(name).take(rows_) for name in ("d", "h")},
                    "at": pa.array([found.place[one[1]] - found.base[one[0]] for one in taken], pa.int32()),
                    "until": pa.array([found.place[one[2] - 1] + 1 - found.base[one[0]] for one in taken], pa.int32()),
                    "key": pa.array([one[3] for one in taken], pa.int64()),
                    "slots": pa.array([found.slots(reading, *one[1:3]) for one, reading in taken.items()], pa.list_(pa.string())),
                    "width": pa.array([one[4] for one in taken], pa.int32()),
                    "n_tokens": pa.array(found.sizes, pa.int64()).take(rows_),
                }
            )

    return rows


Window = tuple[int, int, int, int, tuple[str, ...], tuple[str, ...]]


def share_held(windows: Iterable[Window], n_tokens: int) -> float:
    """The share of an item of ``n_tokens`` that a document holds best in one place.

    ``windows`` are (step, item's place, its end, ... ) of the windows that both have, with the fillings of
    the item and of the document.  Those of neighbouring steps count together.  If they agree on the filling of
    every slot, the share is that of the item's tokens they cover; else those against the commonest filling are
    left out, and the share is that of the item's windows.
    """
    best, band = 0.0, []
    for one in sorted(windows):
        if band and one[0] > band[-1][0] + GAP:
            best, band = max(best, _share(band, n_tokens)), []
        band.append(one)
    return max(best, _share(band, n_tokens)) if band else 0.0


def _share(band: list[Window], n_tokens: int) -> float:
    votes: dict[str, Counter] = {}
    for *_, of_item, of_document in band:
        for one, other in set(zip(of_item, of_document)):
            votes.setdefault(one, Counter())[other] += 1
    chosen = {one: min(found, key=lambda other: (-found[other], other)) for one, found in votes.items()}
    agreed = [w for w in band if all(chosen[one] == other for one, other in zip(w[-2], w[-1]))]
    if len(agreed) == len(band):
        covered = {at for w in band for at in range(w[1], w[2])}
        return len(covered) / n_tokens
    return min(1.0, len({w[1] for w in agreed}) / max(1, n_tokens - WINDOW + 1))


def judge_shares(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task that gives the share of each item that a row holds."""
    for batch in batches:
        shares = []
        for at in range(batch.num_rows):
            met = batch.column("met")[at].as_py()
            shares.append(
                share_held(
                    {(w["at"] - w["item_at"], w["item_at"], w["item_until"], w["at"], tuple(w["item_slots"]), tuple(w["slots"])) for w in met},
                    batch.column("n_tokens")[at].as_py(),
                )
            )
        yield pa.RecordBatch.from_pydict({**{name: batch.column(name) for name in ("d", "h", "item_id")}, "share": pa.array(shares, pa.float64())})


SCHEMA = f"d long, h long, {WINDOWS}, width int, n_tokens long"


def contaminated(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(d, h, item_id, share) for each row of ``df`` (doc_id, text) and item of ``benchmark`` (item_id, text) it holds.

    A row holds an item if the windows they share at nearly the same places, with consistent slots, cover at
    least 0.8 of the item's tokens; if slots contradict each other, the windows that agree with the commonest
    fillings must be 0.8 of the item's.  Tokens are words, runs of names or of numbers, and units.  Items of fewer
    than 8 tokens are one window, matched whole; those of fewer than 5, or
    without text, are too short to tell and match nothing.  Rows with NULL or empty texts hold nothing.  Items
    may repeat; those that share an item_id are told apart by their texts.  An item_id may have any type that can be
    grouped by and ordered; a NULL one of whole numbers is the largest of them.  (d, h) is the row's key: doc_id with NULL as the
    largest number, and a hash of the text.

    Documents are read once for every million different windows of the benchmark, whose keys are sent
    to the tasks; the windows found are joined with the benchmark's.
    """
    spark = df.sparkSession
    whole = isinstance(benchmark.schema["item_id"].dataType, IntegralType)
    # ids that are no whole numbers are known by a hash of them and of the item's text, and joined back
    item_key = F.col("item_id") if whole else F.when(F.col("item_id").isNotNull(), F.xxhash64("item_id"))
    items = benchmark.select(item_key.alias("doc_id"), "text")
    known = stage(
        keyed(items).select("d", "h", "text").mapInArrow(template_windows(None), SCHEMA)
        .select(
            F.col("d").alias("item_id"), F.col("h").alias("item_h"), F.col("at").alias("item_at"), F.col("until").alias("item_until"),
            "width", "key", F.col("slots").alias("item_slots"), "n_tokens",
        )
        .distinct(),
        "benchmark-windows",
    )
    if not whole:
        names = benchmark.select(
            F.coalesce(item_key, F.lit(NO_ID)).alias("item_key"), F.xxhash64("text").alias("item_h"), "item_id"
        ).distinct()
        known = stage(known.withColumnRenamed("item_id", "item_key").join(names, ["item_key", "item_h"]).drop("item_key"), "named-windows")
    n_blocks = max(1, math.ceil(known.count() / BLOCK))
    rows = keyed(df).select("d", "h", "text")
    found = None
    for block in range(n_blocks):
        keys = known.where(F.pmod("key", F.lit(n_blocks)) == block).select("width", "key").distinct().collect()
        wanted: dict[int, list[int]] = {}
        for row in keys:
            wanted.setdefault(row["width"], []).append(row["key"])
        sorted_keys = {width: np.sort(np.array(values, np.int64).view(np.uint64)) for width, values in wanted.items()}
        part = rows.mapInArrow(template_windows(sorted_keys), SCHEMA).drop("n_tokens", "until")
        found = part if found is None else found.unionByName(part)
    found = stage(found, "document-windows")
    met = found.join(known, ["key", "width"]).groupBy("d", "h", "item_id", "item_h", "n_tokens").agg(
        F.collect_set(F.struct("at", "item_at", "item_until", "item_slots", "slots")).alias("met")
    )
    id_type = met.schema["item_id"].dataType.simpleString()
    shares = met.mapInArrow(judge_shares, f"d long, h long, item_id {id_type}, share double")
    return shares.where(F.col("share") >= LEAST_SHARE).groupBy("d", "h", "item_id").agg(F.max("share").alias("share"))


def judge_documents(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_items, item_id and share of every row of ``df``, and ``kept``, false if it holds an item.

    item_id is the smallest of the items with the largest share; it and share are NULL for clean rows.
    """
    held = contaminated(df, benchmark).groupBy("d", "h").agg(
        F.count(F.lit(1)).alias("n_items"), F.min(F.struct((-F.col("share")).alias("minus"), F.col("item_id").isNull().alias("unnamed"), "item_id")).alias("best")
    )
    rows = keyed(df).select("doc_id", "d", "h")
    met = rows.join(stage(held, "contaminated"), ["d", "h"], "left")
    return met.select(
        "doc_id", F.coalesce("n_items", F.lit(0)).alias("n_items"), F.col("best.item_id").alias("item_id"),
        (-F.col("best.minus")).alias("share"), F.col("n_items").isNull().alias("kept"),
    )


def without_contaminated(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``df`` (doc_id, text and any other columns) that hold no item, unchanged."""
    held = stage(contaminated(df, benchmark).select(F.col("d").alias("_d"), F.col("h").alias("_h")).distinct(), "contaminated")
    return keep_keys(df, held, "left_anti")
