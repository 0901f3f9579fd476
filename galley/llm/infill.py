"""Fill-in-middle transformation with cuts found in an indexable skip list.

A text's units (words of ASCII letters, or one other character each) are the nodes of the
lowest lane. A node rises to the next lane by a coin that its number decides, so an express
lane holds about every fourth node of the lane below; each node knows how many units and
how many code points lie before the next node of its lane. Descending from the top lane and
adding up these widths reaches the unit of any rank, and with it the code point at which
to cut, in a number of steps that grows with the logarithm of the text. The lists of all
texts of a batch lie one after another in the same arrays and are descended together.

The numbers h1 to h4 (the first four groups of eight hexadecimal digits of the SHA-256 of
``seed:key``) choose both ranks, whether a text is transformed and in which order its parts
are written:

* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle;
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle;
* ``plain``: the text as it is, also where it is empty or contains a marker.

As a transformed text contains no marker of its own, `restored` takes it apart exactly.

Defined cases: a null text is empty, an empty text is plain; a null key is the empty text;
equal rows are transformed alike; other columns than those asked for are not carried, and
names asked for that clash with a result's are refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.llm.common import as_text, kept_names, map_rows, mixed, quoted, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RESULTS = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}


@dataclass(frozen=True)
class Settings:
    seed: int = 1
    #: of a hundred texts, so many are transformed, and so many of those as ``spm``
    transformed: int = 90
    suffix_first: int = 20
    #: nodes of a lane for one of the lane above, on average (a power of two)
    spread: int = 4


class SkipList:
    """Lanes of the units of many texts; every text has a head and a tail of full height.

    ``units[k]`` and ``points[k]`` are the widths of the nodes of lane ``k``, ``below[k]``
    their places in lane ``k - 1``. Tails are as wide as nothing, and are never left.
    """

    def __init__(self, texts: pa.Array, spread: int = 4):
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        folded = raw | 32
        letter = (raw < 128) & (folded >= 97) & (folded <= 122)
        opens = (raw & 0xC0) != 0x80  # continuation bytes open nothing
        begins = opens.copy()
        begins[1:] &= ~(letter[1:] & letter[:-1])
        begins[bounds[:-1][bounds[:-1] < len(raw)]] = True
        at = np.flatnonzero(begins)
        before = np.concatenate(([0], np.cumsum(opens)))
        first = np.searchsorted(at, bounds)  # the first unit of each text
        self.sizes = np.diff(first)
        points = before[np.append(at, len(raw))[1:]] - before[at]

        # a text's nodes are its units and its tail; an empty text is a tail alone
        texts_n, heads = len(self.sizes), first[:-1] + np.arange(len(self.sizes))
        tails = heads + self.sizes
        units = np.ones(len(at) + texts_n, np.int64)
        units[tails] = 0
        wide = np.zeros(len(units), np.int64)
        wide[units > 0] = points
        self.units, self.points, self.below = [units], [wide], [np.zeros(0, np.int64)]
        ordinal = np.arange(len(units)) - np.repeat(heads, self.sizes + 1)
        coins = mixed(ordinal.view(np.uint64))
        ends = np.zeros(len(units), bool)
        ends[heads] = ends[tails] = True
        self.heads, self.tails = [heads], [tails]
        while int((tails - heads).max(initial=0)) > spread:
            rises = ends | (coins % np.uint64(spread) == 0)
            kept = np.flatnonzero(rises)
            self.below.append(kept)
            units, wide = np.add.reduceat(units, kept), np.add.reduceat(wide, kept)
            place = np.cumsum(rises) - 1
            heads, tails = place[heads], place[tails]
            coins, ends = coins[kept] // np.uint64(spread), ends[kept]
            self.units.append(units)
            self.points.append(wide)
            self.heads.append(heads)
            self.tails.append(tails)

    def code_points(self, texts: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Code points before the unit of each rank, from 0 to the number of units, in its text."""
        node = self.heads[-1][texts]
        passed, points = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for lane in range(len(self.units) - 1, -1, -1):
            units, wide, tail = self.units[lane], self.points[lane], self.tails[lane][texts]
            moving = np.arange(len(texts))
            while len(moving):
                here = node[moving]
                fits = (here < tail[moving]) & (passed[moving] + units[here] <= ranks[moving])
                moving, here = moving[fits], here[fits]
                passed[moving] += units[here]
                points[moving] += wide[here]
                node[moving] = here + 1
            if lane:
                node = self.below[lane][node]
        return points


def _written(settings: Settings):
    markers = (PREFIX, SUFFIX, MIDDLE)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__llm_text", 1 << 20):
            texts = as_text(batch.column("__llm_text"))
            lanes = SkipList(texts, settings.spread)
            h = [batch.column(f"__llm_h{k}").to_numpy() for k in (1, 2, 3, 4)]
            n, rows = lanes.sizes, np.arange(len(texts))
            x, y = h[0] % (n + 1), h[1] % (n + 1)
            starts = lanes.code_points(rows, np.minimum(x, y)).tolist()
            ends = lanes.code_points(rows, np.maximum(x, y)).tolist()
            changed = (h[2] % 100 < settings.transformed).tolist()
            swapped = (h[3] % 100 < settings.suffix_first).tolist()
            forms, prefixes, middles, outputs = [], [], [], []
            for k, text in enumerate(texts.to_pylist()):
                if not text or not changed[k] or any(m in text for m in markers):
                    forms.append("plain")
                    prefixes.append(None)
                    middles.append(None)
                    outputs.append(text)
                    continue
                a, b = starts[k], ends[k]
                prefix, middle, suffix = text[:a], text[a:b], text[b:]
                forms.append("spm" if swapped[k] else "psm")
                prefixes.append(a)
                middles.append(b - a)
                head = (SUFFIX, suffix, PREFIX, prefix) if swapped[k] else (PREFIX, prefix, SUFFIX, suffix)
                outputs.append("".join((*head, MIDDLE, middle)))
            kept = kept_names(batch)
            columns = [pa.array(n, pa.int64()), pa.array(forms, pa.string())]
            columns += [pa.array(c, pa.int64()) for c in (prefixes, middles)]
            columns += [pa.array(outputs, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], names=[*kept, *RESULTS])

    return write


def transform(
    docs: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", settings: Settings | None = None
) -> DataFrame:
    """The columns ``keep`` of every document with n, form, prefix_chars, middle_chars and output.

    ``n`` counts units; both lengths are code points and null where the form is plain.
    """
    settings = settings or Settings()
    digits = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col(quoted(key)).cast("string"), F.lit(""))), 256)
    numbers = [
        F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long").alias(f"__llm_h{k + 1}") for k in range(4)
    ]
    inputs = [F.col(quoted(text)).cast("string").alias("__llm_text"), *numbers]
    return map_rows(docs, keep, inputs, _written(settings), RESULTS)


def restored(output: Column, form: Column) -> Column:
    """The text that `transform` was given, from what it wrote and the form."""
    psm = F.regexp_replace(output, "(?s)^<P>(.*?)<S>(.*?)<M>(.*)$", "$1$3$2")
    spm = F.regexp_replace(output, "(?s)^<S>(.*?)<P>(.*?)<M>(.*)$", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
