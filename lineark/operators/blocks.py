"""Neighbourhoods along one integer coordinate, on blocks with a halo.

A value is sent to its own block of coordinates and, as halo, to the blocks that hold a
target within reach of it: ``1 + reach / block`` copies on average, in one shuffle on
``(keys, block)``, so a long series spreads over many tasks.  Each task reads its blocks as
one sorted stream and holds the reach of one target and a few Arrow batches, never a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 4096         # least coordinates in a block
FILL = 20_000        # rows a task gathers before it reckons, at least


def sliding(df: DataFrame, keys: list[str], dim: str, values: dict[str, Column], before: int, after: int,
            reckon: Callable, schema: str) -> DataFrame:
    """Apply ``reckon`` to every coordinate together with the ones from ``before`` behind to ``after`` ahead of it.

    Rows of one ``(keys, dim)`` are first merged by the aggregates ``values``.  ``reckon(at, place, cols, due)``
    gets numpy arrays over sorted rows: ``at``, the number of the row's block; ``place``, an integer that
    rises by the coordinates' difference inside a block and by more than the reach between blocks; ``cols``,
    the Arrow columns of ``values`` and the coordinate ``at``; ``due``, the rows to answer now, each of which is due once.  It
    returns ``(rows, columns)``: for each output row the input row that its keys come from, and the
    output columns named by ``schema`` (which follow ``keys``).  Rows without a coordinate are left out.
    """
    block = max(BLOCK, 8 * (before + after))
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.where(F.col(dim).isNotNull()).select(
        *(F.col(k).alias(n) for k, n in zip(keys, names)), F.col(dim).cast("bigint").alias("_at"),
        *[c for c in dict.fromkeys(df.columns) if c not in (*keys, dim)])

    def of(shift: int) -> Column:
        return F.expr(f"(_at + {shift} - pmod(_at + {shift}, {block}L)) div {block}L")

    spread = rows.withColumn("_blk", F.explode(F.sequence(of(-after), of(before))))
    # Partitioned by block, the merge per coordinate and the sort need no second shuffle.
    merged = (spread.repartition(*names, "_blk").groupBy(*names, "_blk", "_at")
              .agg(*(c.alias(f"_v{i}") for i, c in enumerate(values.values()))))
    in_order = merged.sortWithinPartitions(*names, "_blk", "_at")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)
    out = in_order.mapInArrow(_stream(names, list(values), before, after, block, reckon), ", ".join(filter(None, [kinds, schema])))
    return out.select(*(F.col(n).alias(k) for n, k in zip(names, keys)), *[c for c in out.columns if c not in names])


def _stream(names: list[str], values: list[str], before: int, after: int, block: int, reckon: Callable):
    """mapInArrow function of :func:`sliding` over rows sorted by ``(keys, block, coordinate)``."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def starts(table):
            new = np.zeros(table.num_rows, bool)
            new[0] = True
            for name in [*names, "_blk"]:
                c = table.column(name)
                a, b = c.slice(1), c.slice(0, len(c) - 1)
                differ = pc.if_else(pc.and_(pc.is_null(a), pc.is_null(b)), False, pc.fill_null(pc.not_equal(a, b), True))
                new[1:] |= differ.to_numpy().astype(bool)
            return new

        def answer(table, done, last):
            """Output of the rows that are complete, and the rows to keep with their marks."""
            at = np.cumsum(starts(table)) - 1
            where, blk = table.column("_at").to_numpy(), table.column("_blk").to_numpy()
            inside = where - blk * block + before                     # 0 .. block + before + after
            place = at * (block + 2 * (before + after) + 2) + inside
            open_rows = np.zeros(len(at), bool) if last else (at == at[-1]) & (where > where[-1] - after)
            core = (inside >= before) & (inside < block + before)
            due = core & ~open_rows & ~done
            cols = {"at": table.column("_at"), **{v: table.column(f"_v{i}") for i, v in enumerate(values)}}
            rows, made = reckon(at, place, cols, due)
            out = pa.table({**{n: table.column(n).take(pa.array(rows)) for n in names}, **made})
            keep = np.zeros(len(at), bool) if last else (at == at[-1]) & (where > where[-1] - after - before)
            return out, table.filter(pa.array(keep)), (done | due)[keep]

        held, done, waiting, size = None, np.zeros(0, bool), [], 0
        fill = max(FILL, 4 * (before + after))
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size < fill:
                continue
            table = pa.concat_tables(([held] if held is not None else []) + waiting).combine_chunks()
            out, held, done = answer(table, np.concatenate((done, np.zeros(table.num_rows - len(done), bool))), False)
            waiting, size = [], 0
            yield from out.to_batches()
        rest = ([held] if held is not None and held.num_rows else []) + waiting
        if rest:
            table = pa.concat_tables(rest).combine_chunks()
            out, _, _ = answer(table, np.concatenate((done, np.zeros(table.num_rows - len(done), bool))), True)
            yield from out.to_batches()
    return run


def gaussian(*sigmas: float):
    """``reckon`` for Gaussian-weighted means of the present values (columns ``sum`` and ``n``) with each of
    ``sigmas``, radius ``ceil(3 sigma)``; with two sigmas the difference of the two means."""
    import math

    def run(at, place, cols, due):
        import numpy as np
        import pyarrow as pa
        count = cols["n"].to_numpy().astype(float)
        total = np.where(count > 0, cols["sum"].to_numpy(), 0.0)
        rows = np.flatnonzero(due)
        means, empty = [], np.zeros(len(rows), bool)
        for sigma in sigmas:
            over, under = np.zeros(len(rows)), np.zeros(len(rows))
            radius = math.ceil(3 * sigma)
            for o in range(-radius, radius + 1):
                i = np.minimum(np.searchsorted(place, place[rows] + o), len(place) - 1)
                w = np.where(place[i] == place[rows] + o, math.exp(-o * o / (2.0 * sigma * sigma)), 0.0)
                there = (w > 0) & (count[i] > 0)
                over[there] += w[there] * total[i[there]]
                under[there] += w[there] * count[i[there]]
            with np.errstate(all="ignore"):
                means.append(np.where(under > 0, over / under, 0.0))
            empty |= under == 0
        v = means[0] if len(means) == 1 else means[0] - means[1]
        return rows, {"_at": pa.array(cols["at"].to_numpy()[rows]), "_v": pa.array(v, mask=empty)}
    return run


def extremes(radius: int):
    """``reckon`` for the greatest and the least value within ``radius`` (columns ``max``, ``min``, ``n``): spans of
    twice the length in each step, of which two cover any window.  NaN is greater than any number."""

    def run(at, place, cols, due):
        import numpy as np
        import pyarrow as pa
        rows = np.flatnonzero(due)
        there = cols["n"].to_numpy() > 0
        lo = np.searchsorted(place, place[rows] - radius, "left")
        hi = np.searchsorted(place, place[rows] + radius, "right")
        level = np.floor(np.log2(np.maximum(hi - lo, 1))).astype(int)
        most, least = np.where(there, cols["max"].to_numpy(), -np.inf), np.where(there, cols["min"].to_numpy(), np.nan)
        up, down = np.empty(len(rows)), np.empty(len(rows))
        for k in range(level.max(initial=0) + 1):
            mine = level == k
            a, b = lo[mine], hi[mine] - (1 << k)
            up[mine], down[mine] = np.maximum(most[a], most[b]), np.fmin(least[a], least[b])
            step = 1 << k
            if len(most) > step:
                most, least = np.maximum(most[:-step], most[step:]), np.fmin(least[:-step], least[step:])
        before = np.concatenate(([0], np.cumsum(there)))
        empty = before[hi] == before[lo]
        return rows, {"_at": pa.array(cols["at"].to_numpy()[rows]), "_up": pa.array(up, mask=empty), "_down": pa.array(down, mask=empty)}
    return run


def triples(tau: int):
    """``reckon`` for the values (column ``y``) at a position, ``tau`` and ``2 tau`` after it, where none is missing."""

    def run(at, place, cols, due):
        import numpy as np
        import pyarrow as pa
        y = cols["y"].combine_chunks()
        there = ~y.is_null().to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(due & there)
        found = [rows]
        for step in (tau, 2 * tau):
            j = np.minimum(np.searchsorted(place, place[rows] + step), len(place) - 1)
            found.append(np.where((place[j] == place[rows] + step) & there[j], j, -1))
        full = (found[1] >= 0) & (found[2] >= 0)
        rows = rows[full]
        return rows, {"i": pa.array(cols["at"].to_numpy()[rows]), **{f"y{k}": y.take(pa.array(f[full])) for k, f in enumerate(found)}}
    return run


def lagged_sums(lo: int, hi: int, exact: bool):
    """``reckon`` for the sums over the pairs ``(y_i, y_{i+lag})`` of present values (column ``y``) for each lag
    from ``lo`` to ``hi``: their number, and the sums of the products, of the first and of the second values.
    ``exact``: ``y`` are whole numbers, and so are the sums, as DECIMAL."""

    def run(at, place, cols, due):
        from decimal import Decimal

        import numpy as np
        import pyarrow as pa
        there = ~cols["y"].combine_chunks().is_null().to_numpy(zero_copy_only=False)
        if exact:
            y = np.array([int(v) if v is not None else 0 for v in cols["y"].to_pylist()], object)
            if len(y) * max((abs(v) for v in y), default=0) ** 2 < 1 << 62:
                y = y.astype(np.int64)
        else:
            y = np.where(there, cols["y"].to_numpy(), 0.0)
        rows = np.flatnonzero(due)
        if not len(rows):
            return rows, {c: pa.array([], t) for c, t in _sum_types(exact).items()}
        first = np.flatnonzero(np.concatenate(([True], np.diff(at[rows]) != 0)))
        found = {c: [] for c in ("from", "lag", "m", "p", "a", "b")}
        for lag in range(lo, hi + 1):
            j = np.minimum(np.searchsorted(place, place[rows] + lag), len(place) - 1)
            both = (place[j] == place[rows] + lag) & there[rows] & there[j]
            left, right = np.where(both, y[rows], 0), np.where(both, y[j], 0)
            m = np.add.reduceat(both.astype(np.int64), first)
            some = np.flatnonzero(m)
            found["from"].append(rows[first[some]])
            found["lag"].append(np.full(len(some), lag))
            found["m"].append(m[some])
            for c, x in (("p", left * right), ("a", left), ("b", right)):
                found[c].append(np.add.reduceat(x, first)[some])
        made = {c: np.concatenate(x) for c, x in found.items()}
        types = _sum_types(exact)
        number = (lambda x: [Decimal(int(v)) for v in x]) if exact else list
        return made.pop("from"), {c: pa.array(number(x) if c in ("p", "a", "b") else x, types[c]) for c, x in made.items()}
    return run


def _sum_types(exact: bool):
    import pyarrow as pa
    number = pa.decimal128(38, 0) if exact else pa.float64()
    return {"lag": pa.int64(), "m": pa.int64(), "p": number, "a": number, "b": number}
