"""Fill-in-the-middle transformation of whole texts, cut at exact unit ranks by an indexable skip list.

A text's units are its runs of ASCII letters and its other single code points.
Two ranks drawn from a hash of the id cut it into prefix, middle and suffix.
:class:`UnitList` is a skip list over the units: the bottom lane has a link per
unit, each lane above a link for every ``FAN`` of the lane below, and each link
carries how many units and how many code points it passes.  A rank is reached
from the top lane downwards, never passing a link that leads beyond it, in at
most ``FAN`` steps a lane; the code points passed are the place of the cut.

Orders.  ``psm``: prefix, suffix, middle, each after its marker; ``spm``: suffix,
prefix, middle; ``plain``: the text as it is.  A text that is empty or holds a
marker stays plain, so the markers of an output are its own and
:func:`restored` finds the text again.

Work is row-local (no shuffle); memory is bounded by one Arrow batch and eight
bytes per unit of the longest text, which is measured in blocks.

Defined results: a null text is empty; a null id is hashed as the empty string;
rows with equal ids and texts get equal outputs; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import map_columns

FAN = 16
BLOCK = 1 << 20
#: The markers of prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")


def unit_widths(text: str) -> np.ndarray:
    """Code points of every unit, in order."""
    starts, letter_before = [], False
    for i in range(0, len(text), BLOCK):
        points = np.frombuffer(text[i:i + BLOCK].encode("utf-32-le", "surrogatepass"), "<u4")
        letter = ((points | 32) - np.uint32(97)) < 26
        inside = letter.copy()
        inside[1:] &= letter[:-1]
        inside[0] &= letter_before
        starts.append(np.flatnonzero(~inside) + i)
        letter_before = bool(letter[-1])
    return np.diff(np.concatenate(starts), append=len(text)) if starts else np.empty(0, np.int64)


class UnitList:
    """Indexable skip list of a text's units; a lane is a pair of arrays, units and code points that a link passes."""

    def __init__(self, widths: np.ndarray):
        self.lanes = [(np.ones(len(widths), np.int64), widths)]
        while len(self.lanes[-1][0]) > FAN:
            at = np.arange(0, len(self.lanes[-1][0]), FAN)
            self.lanes.append(tuple(np.add.reduceat(w, at) for w in self.lanes[-1]))

    def __len__(self) -> int:
        return len(self.lanes[0][0])

    def code_points(self, rank: int) -> int:
        """Code points before the unit of this rank (all of them at the rank after the last)."""
        link = passed = 0
        for units, points in reversed(self.lanes):
            while link < len(units) and units[link] <= rank:
                rank -= int(units[link])
                passed += int(points[link])
                link += 1
            link *= FAN
        return passed


def draws(id_text: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the sha256 of ``<seed>:<id>``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_text, F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def arrange(text: str, h: tuple[int, int, int, int], fim_percent: int, spm_percent: int) -> tuple:
    """``(units, form, prefix code points, middle code points, output)`` of one text."""
    units = UnitList(unit_widths(text))
    if not text or any(m in text for m in MARKERS) or h[2] % 100 >= fim_percent:
        return len(units), "plain", None, None, text
    a, z = (units.code_points(rank) for rank in sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1))))
    prefix, middle, suffix = text[:a], text[a:z], text[z:]
    p, s, m = MARKERS
    if h[3] % 100 < spm_percent:
        return len(units), "spm", a, z - a, "".join((s, suffix, p, prefix, m, middle))
    return len(units), "psm", a, z - a, "".join((p, prefix, s, suffix, m, middle))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, fim_percent: int = 90,
              spm_percent: int = 20, keep: list[str] | None = None) -> DataFrame:
    """``(row, n, form, prefix_chars, middle_chars, output)`` for every row of ``docs``."""
    columns = docs.columns if keep is None else keep
    draw = F.struct(*[d.alias(f"h{i + 1}") for i, d in enumerate(draws(F.col(f"`{id_col}`").cast("string"), seed))])
    table = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), draw.alias("in_draws"), F.col(f"`{text_col}`").alias("in_text"))

    def make():
        def fn(numbers, col):
            h = zip(*[numbers.field(i).to_pylist() for i in range(4)])
            n, form, prefix, middle, output = zip(*[arrange(t or "", x, fim_percent, spm_percent) for t, x in zip(col.to_pylist(), h)])
            return [pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())]
        return fn
    fields = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
              T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]
    return map_columns(table, ["in_draws", "in_text"], fields, make)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from (null output: null)."""
    p, s, m = MARKERS

    def after(x: Column, head: Column, marker: str) -> Column:
        return F.substring(x, F.length(head) + len(marker) + 1, F.length(x))
    body = F.substring(output, len(p) + 1, F.length(output))  # markers are equally long
    first = F.when(form == "psm", F.substring_index(body, s, 1)).otherwise(F.substring_index(body, p, 1))
    rest = after(body, first, s)
    second = F.substring_index(rest, m, 1)
    middle = after(rest, second, m)
    return (F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first))
            .otherwise(output))
