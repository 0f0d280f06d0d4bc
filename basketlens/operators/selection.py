"""Exact selection of ranked rows by repeated histograms, without sorting or shuffling the rows.

A rank under (value, id) is found by narrowing: a pass counts the rows of
every open bracket in a bounded number of bins, keeps the bin that holds the
rank (with its exact least and greatest value), and the next pass cuts that
one.  A bracket of a single value goes on with the ids in it; a bracket of few
rows is read out.  Every pass is one aggregate whose result has at most
ranks x bins rows, so what reaches the driver does not grow with the data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 2048
READ_OUT = 4096


@dataclass
class Bracket:
    """Rows that may hold a rank: of value column ``spec``, between two values, or of one value between two ids."""
    spec: int
    rank: int                  # 1-based, inside the bracket
    n: int
    value: tuple | None = None       # (least, greatest)
    fixed: bool = False              # one value, ``at`` (null counts as one): ids decide
    at: Any = None
    ids: tuple | None = None         # (least, greatest)
    prefix: str = ""                 # the common beginning of string ids


def _literal(value: Any, kind: T.DataType) -> Column:
    return F.lit(value).cast(kind)


def _scaled(x: Column, low: Any, high: Any, kind: T.DataType) -> Column:
    """Bin 0..BINS-1 of a numeric ``x`` between ``low`` and ``high``: never falls as ``x`` grows, ends apart."""
    if isinstance(kind, T.IntegralType):
        x, low_, high_ = x.cast("decimal(20,0)"), F.lit(low).cast("decimal(20,0)"), F.lit(high).cast("decimal(20,0)")
    else:
        low_, high_ = _literal(low, kind), _literal(high, kind)
    share = (x - low_).cast("double") / (high_ - low_).cast("double")
    return F.least(F.lit(BINS - 1), F.floor(share * BINS)).cast("int")


def _inside(b: Bracket, value: Column, kind: T.DataType, id_: Column, id_kind: T.DataType) -> Column:
    if not b.fixed:
        return value.between(_literal(b.value[0], kind), _literal(b.value[1], kind))
    same = value.isNull() if b.at is None else value == _literal(b.at, kind)
    if b.ids is not None:
        same = same & id_.between(_literal(b.ids[0], id_kind), _literal(b.ids[1], id_kind))
    return F.coalesce(same, F.lit(False))


def _bin(b: Bracket, value: Column, kind: T.DataType, id_: Column, id_kind: T.DataType) -> Column:
    """Key of a row's bin, as text that sorts in bin order within its own kind of bracket."""
    x, x_kind, span = (id_, id_kind, b.ids) if b.fixed else (value, kind, b.value)
    if isinstance(x_kind, T.StringType):
        key = F.substring(x, 1, len(b.prefix) + 2) if b.fixed else x
    elif span is None:   # ids of one value: the first pass finds their ends
        key = F.lit("0")
    else:
        key = F.lpad(_scaled(x, span[0], span[1], x_kind).cast("string"), 6, "0")
    return F.when(x.isNotNull(), key)


def select_ranks(df: DataFrame, specs: list[tuple[Column, bool]], id_col: str,
                 ranks: list[list[int]] | Callable[[int], list[list[int]]]) -> list[list[tuple]]:
    """For each ``(value, descending)`` of ``specs`` the exact (value, id) pairs at its 1-based ``ranks``,
    given as such or as a function of the number of rows.

    Order: value (nulls first ascending, last descending), then id ascending
    (null first).  Values are numbers, ids whole numbers or strings.  ``df``
    is read once a pass: it should be a stored table.  A rank beyond the rows
    gives (None, None).
    """
    id_ = F.col(id_col)
    id_kind = df.schema[id_col].dataType
    kinds = [f.dataType for f in df.select(*[v for v, _ in specs]).schema.fields]
    ends = df.agg(F.count(F.lit(1)).alias("n"), *[f(v).alias(f"{name}{i}") for i, (v, _) in enumerate(specs)
                                                  for name, f in (("lo", F.min), ("hi", F.max), ("some", F.count))]).first()
    ranks = ranks(ends.n) if callable(ranks) else ranks
    open_ = {}
    for i, rs in enumerate(ranks):
        some, nulls = ends[f"some{i}"], ends.n - ends[f"some{i}"]
        before = 0 if specs[i][1] else nulls
        for r in rs:
            if 1 <= r <= ends.n:
                open_[i, r] = (_of_values(i, r - before, some, ends[f"lo{i}"], ends[f"hi{i}"]) if before < r <= before + some
                               else Bracket(i, r - (some if specs[i][1] else 0), nulls, None, True, None))
    done: dict = {}
    while open_:
        brackets = list({(b.spec, b.value, b.fixed, b.at, b.ids): b for b in open_.values()}.values())
        few = [b for b in brackets if b.n <= READ_OUT]
        cells = []
        for k, b in enumerate(brackets):
            value = specs[b.spec][0]
            cells.append(F.when(_inside(b, value, kinds[b.spec], id_, id_kind), F.struct(
                F.lit(k).alias("k"),
                (F.lit(None).cast("string") if b in few else _bin(b, value, kinds[b.spec], id_, id_kind)).alias("bin"),
                (value.cast("string") if b in few else F.lit(None).cast("string")).alias("v"),
                (id_.cast("string") if b in few else F.lit(None).cast("string")).alias("i"))))
        hit = df.select(*[v.alias(f"_v{i}") for i, (v, _) in enumerate(specs)], id_.alias("_id"),
                        F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("c"))
        # rows that are read out form groups of their own; the others are counted by bin
        groups = (hit.groupBy("c").agg(
            F.count(F.lit(1)).alias("n"),
            *[f(f"_v{i}").alias(f"{name}{i}") for i in range(len(specs)) for name, f in (("lo", F.min), ("hi", F.max))],
            F.min("_id").alias("lo_id"), F.max("_id").alias("hi_id"), F.count("_id").alias("ids")).collect())
        of: dict[int, list] = {k: [] for k in range(len(brackets))}
        for g in groups:
            of[g.c.k].append(g)
        index = {(b.spec, b.value, b.fixed, b.at, b.ids): k for k, b in enumerate(brackets)}
        for key, b in list(open_.items()):
            k = index[(b.spec, b.value, b.fixed, b.at, b.ids)]
            down = specs[b.spec][1]
            if brackets[k] in few:
                rows = [(g[f"lo{b.spec}"], g.lo_id) for g in of[k] for _ in range(g.n)]
                rows.sort(key=lambda x: (x[1] is not None, x[1] if x[1] is not None else 0))
                rows.sort(key=lambda x: (x[0] is not None, x[0] if x[0] is not None else 0), reverse=down)
                done[key] = rows[b.rank - 1]
                del open_[key]
                continue
            bins = sorted(of[k], key=lambda g: (g.c.bin is not None, g.c.bin or ""), reverse=down and not b.fixed)
            rank = b.rank
            for g in bins:
                if rank <= g.n:
                    break
                rank -= g.n
            low, high = (g.lo_id, g.hi_id) if b.fixed else (g[f"lo{b.spec}"], g[f"hi{b.spec}"])
            if b.fixed and low == high:  # one id (null is one): all its rows are alike
                done[key] = (b.at, low)
                del open_[key]
            elif b.fixed:
                open_[key] = Bracket(b.spec, rank, g.n, None, True, b.at, (low, high), _common(low, high))
            elif low == high:  # one value: the ends of its ids are known already
                ids = None if g.lo_id is None else (g.lo_id, g.hi_id)
                if ids and ids[0] == ids[1] and g.lo_id is not None and g.ids == g.n:
                    done[key] = (low, g.lo_id)
                    del open_[key]
                else:
                    open_[key] = Bracket(b.spec, rank, g.n, None, True, low, None if g.ids < g.n else ids,
                                         "" if g.ids < g.n else _common(*ids))
            else:
                open_[key] = Bracket(b.spec, rank, g.n, (low, high))
    return [[done.get((i, r), (None, None)) for r in rs] for i, rs in enumerate(ranks)]


def _of_values(spec: int, rank: int, n: int, low: Any, high: Any) -> Bracket:
    """The bracket of the values from ``low`` to ``high``."""
    return Bracket(spec, rank, n, None, True, low) if low == high else Bracket(spec, rank, n, (low, high))


def _common(low: Any, high: Any) -> str:
    """The common beginning of two strings: bins of strings are the two characters after it."""
    if not isinstance(low, str):
        return ""
    k = 0
    while k < min(len(low), len(high)) and low[k] == high[k]:
        k += 1
    return low[:k]
