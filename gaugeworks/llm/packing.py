"""Best-fit packing of token pieces into sequences of one capacity.

The histogram of lengths (at most as many rows as the capacity) goes to the driver. There a configuration linear
program over it (how often to use each multiset of lengths that fits) is solved by multiplicative weights: a knapsack by dynamic
programming finds for every length the configuration that is worth most at the present prices, and prices of lengths that lack a good one are
multiplied. The solution is rounded to whole uses, the program runs again on what that leaves, and the last hundredth of the tokens is packed
best-fit by decreasing length, also on the histogram. Pieces then find their places by their rank within their
length; no piece but its own numbers moves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import running
from gaugeworks.llm.tokens import WORDS, batches_by_size, encoder

Config = tuple[tuple[int, int], ...]  # (length, copies), from the longest


def best_values(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every room up to the capacity, the most a multiset that fits is worth, and a length it takes (0: one unit stays empty).

    ``price[l]`` is the worth of length l, not above 0 if it may not be used.
    """
    worth = np.where(price > 0, price, -np.inf)[1:]
    longest = int(np.flatnonzero(price > 0).max(initial=0))
    best, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if n := min(c, longest):
            value = best[c - n:c][::-1] + worth[:n]
            k = int(value.argmax())
            if value[k] > best[c]:
                best[c], taken[c] = value[k], k + 1
    return best, taken


def knapsack(price: np.ndarray, capacity: int) -> dict[int, int]:
    """Multiset of lengths of most value that fits."""
    taken = best_values(price, capacity)[1]
    out, c = Counter(), capacity
    while c > 0:
        if taken[c]:
            out[int(taken[c])] += 1
        c -= max(int(taken[c]), 1)
    return out


def lower_bound(demand: dict[int, int], capacity: int, dual: np.ndarray) -> float:
    """No packing needs fewer sequences: the demand at these prices over the most that one sequence can be worth (a dual solution)."""
    price = np.zeros(capacity + 1)
    for length in demand:
        price[length] = dual[length]
    return sum(n * price[length] for length, n in demand.items()) / best_values(price, capacity)[0][capacity] if demand else 0.0


def program(demand: dict[int, int], capacity: int, gap: float = 5e-4, step: float = 0.25, share: float = 0.005, tilt: float = 4e-4) -> tuple[dict[Config, float], np.ndarray]:
    """Fractional uses of configurations that do not exceed the demand of any length, and the prices (a dual solution).

    Prices start at the lengths. Each round solves one knapsack for all rooms, so it prices for every length the best configuration that holds it. Where
    that is worth less than the best of all by more than ``gap``, the length's price is multiplied by what it lacks. The others are used,
    from the longest, until a share ``step`` of a length's open demand is gone; room is filled by what the table says is worth most among the lengths
    that are not gone, and a configuration whose worth falls below ``gap`` is not used. Equal worth is decided by ``tilt``: long lengths and those covered
    least come first. It ends when less than ``share`` of the tokens is open. A round uses at least the best configuration, so each
    uses up a fixed share of a length: the end is always reached.
    """
    count = np.zeros(capacity + 1)
    for length, n in demand.items():
        count[length] = n
    size = np.arange(capacity + 1, dtype=float)
    total, longest = float(count @ size), max(demand, default=0)
    open_, dual, uses = count.copy(), size.copy(), {}
    while open_ @ size > share * total:
        usable = open_ > 1e-6 * count
        price = np.where(usable, dual * (1 + tilt * (size / capacity + open_ / np.maximum(count, 1) - 1)), 0.0)
        best = best_values(price, capacity)[0]
        least = (1 - gap) * best[capacity]
        quota = np.where(usable, np.where(open_ >= 4, step * open_, open_), 0.0)
        worth = np.where(usable, price, -np.inf)[1:]
        for length in np.flatnonzero(usable)[::-1].tolist():
            reach = price[length] + best[capacity - length]
            if reach < least:
                dual[length] *= best[capacity] / reach
                continue
            while quota[length] > 0:
                config, room, value = {length: 1}, capacity - length, price[length]
                while room > 0:
                    n = min(room, longest)
                    reach = best[room - n:room][::-1] + worth[:n]
                    k = int(reach.argmax())
                    if reach[k] == -np.inf:
                        break
                    if reach[k] < best[room - 1]:  # a unit is better left empty
                        room -= 1
                        continue
                    config[k + 1] = config.get(k + 1, 0) + 1
                    room -= k + 1
                    value += price[k + 1]
                if value < least:
                    break
                use = min(quota[m] / k for m, k in config.items())
                key = tuple(sorted(config.items(), reverse=True))
                uses[key] = uses.get(key, 0.0) + use
                for m, k in config.items():
                    quota[m] -= use * k
                    open_[m] -= use * k
                    if quota[m] <= 1e-9 * count[m]:
                        quota[m], worth[m - 1] = 0.0, -np.inf
    return uses, dual


def solve(demand: dict[int, int], capacity: int) -> dict[Config, float]:
    """The uses of :func:`program`."""
    return program(demand, capacity)[0]


def rounded(uses: dict[Config, float], demand: dict[int, int]) -> dict[Config, int]:
    """Whole uses within the demand: fractions are carried on to the next configuration of the same longest length."""
    left, carry, out = Counter(demand), Counter(), {}
    for config, use in sorted(uses.items(), key=lambda c: (-c[0][0][0], -c[1], c[0])):
        lead = config[0][0]
        carry[lead] += use
        whole = min(int(carry[lead] + 1e-6), *(left[length] // k for length, k in config))
        if whole:
            out[config] = whole
            carry[lead] -= whole
            for length, k in config:
                left[length] -= whole * k
    return out


def best_fit(demand: dict[int, int], capacity: int) -> dict[Config, int]:
    """Best-fit decreasing on a histogram: bins with the same content are one group, so work grows with lengths, not pieces."""
    groups: dict[int, Counter] = {}  # room left: contents and their number
    for length in sorted(demand, reverse=True):
        left = demand[length]
        while left:
            room = min((r for r in groups if r >= length), default=None)
            if room is None:
                k = capacity // length
                full, rest = divmod(left, k)
                for copies, bins in ((k, full), (rest, 1)):
                    if copies and bins:
                        groups.setdefault(capacity - copies * length, Counter())[((length, copies),)] += bins
                break
            contents = groups[room]
            content = next(iter(contents))
            bins = contents[content]
            k = min(room // length, left)
            used = max(1, min(bins, left // k))
            contents[content] -= used
            if not contents[content]:
                del contents[content]
                if not contents:
                    del groups[room]
            groups.setdefault(room - k * length, Counter())[content + ((length, k),)] += used
            left -= used * k
    out: dict[Config, int] = Counter()
    for contents in groups.values():
        out.update(contents)
    return out


def plan(demand: dict[int, int], capacity: int) -> dict[Config, int]:
    """Whole uses of configurations that cover the demand exactly.

    They are the program's, and best fit for what its rounding leaves. Where lengths hardly combine (most above a third of the
    capacity, say) best fit alone may need fewer sequences; then its plan is taken.
    """
    out, left = by_program(demand, capacity)
    for config, use in best_fit(left, capacity).items():
        out[config] += use
    alone = best_fit(demand, capacity)
    return out if sum(out.values()) <= sum(alone.values()) else alone


def by_program(demand: dict[int, int], capacity: int, share: float = 0.01) -> tuple[Counter[Config], dict[int, int]]:
    """Whole uses found by the program, and the demand left.

    What rounding leaves is demand again, until less than ``share`` of the tokens is left or a program places less than a tenth of them.
    """
    out: Counter[Config] = Counter()
    left, tokens = Counter(demand), lambda d: sum(n * k for n, k in d.items())
    total = tokens(demand)
    while (open_ := tokens(left)) > share * total:
        for config, use in rounded(solve(left, capacity), left).items():
            out[config] += use
            for length, k in config:
                left[length] -= use * k
        left = Counter({n: k for n, k in left.items() if k})
        if tokens(left) > 0.9 * open_:
            break
    return out, dict(left)


def places(configs: dict[Config, int]) -> dict[int, list[tuple[int, int, int, int]]]:
    """Per length, for ascending ranks: (first rank, first sequence, sequences, first offset); copies in a sequence follow one another."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter = Counter()
    sequence = 0
    for config, uses in sorted(configs.items()):
        offset = 0
        for length, k in config:
            out.setdefault(length, []).append((ranks[length], sequence, uses, offset))
            ranks[length] += k * uses
            offset += k * length
        sequence += uses
    return out


def pack(pieces: DataFrame, capacity: int, order: list[str], length: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every piece; such columns are replaced.

    Lengths must be from 1 to the capacity (others fail). ``order`` tells pieces of one length apart; equal rows are interchangeable. The
    histogram and the plan have at most as many rows as the capacity, so they are small whatever the input.
    """
    pieces = pieces.drop("sequence_id", "offset")
    counts = pieces.groupBy(F.col(length).alias("n")).count().collect()
    demand = {int(r["n"]): int(r["count"]) for r in counts if r["n"] is not None}
    if any(r["n"] is None or not 1 <= r["n"] <= capacity for r in counts):
        raise ValueError(f"piece lengths must be 1 to {capacity}")
    if not demand:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    found = places(plan(demand, capacity))
    rows, before = [], 0
    for n in sorted(demand):
        first, start, bins, offset = zip(*found[n], strict=True)
        rows.append((n, before, list(first), list(start), list(bins), list(offset)))
        before += demand[n]
    where = pieces.sparkSession.createDataFrame(rows, "_n int, _before long, _first array<long>, _start array<long>, _bins array<long>, _offset array<long>")
    ranked = running(pieces, [length, *order], {"_place": F.lit(1)})
    at = ranked.join(F.broadcast(where), F.col(length) == F.col("_n")).withColumn("_rank", F.col("_place") - F.col("_before"))
    at = at.withColumn("_k", F.size(F.filter("_first", lambda r: r <= F.col("_rank"))))
    pick = lambda c: F.element_at(c, F.col("_k"))
    at = at.withColumn("_within", F.col("_rank") - pick("_first"))
    return at.select(*pieces.columns, (pick("_start") + F.col("_within") % pick("_bins")).alias("sequence_id"),
                     (pick("_offset") + F.col(length) * F.floor(F.col("_within") / pick("_bins"))).cast("long").alias("offset"))


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, text: str = "text", words: int = WORDS, chars: int = 4_000_000) -> DataFrame:
    """Ids of each whole text with an end id, longer ones cut at the capacity: ``piece``, ``start``, ``length``, ``ids`` (binary).

    The text and columns of these names are replaced. A null text counts as empty and gives one piece of the end id; repeated rows give their pieces each.
    ``words`` (kept by a worker) and ``chars`` (encoded at once) bound memory, at the price of time.
    """
    made = ["piece", "start", "length", "ids"]
    kept = [c for c in docs.columns if c not in (text, *made)]
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + ["piece int, start long, length long, ids binary"])
    end, width = int(end_id).to_bytes(4, "little"), 4 * capacity

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in batches_by_size(batch, text, chars):
                ids = [i + end for i in encoder(tokenizer, words).encode(["" if t is None else t for t in part[text]])]
                counts = np.array([-(-len(i) // width) for i in ids])
                found = [(k, k * capacity, min(width, len(i) - k * width) // 4, i[k * width:(k + 1) * width]) for i, n in zip(ids, counts, strict=True) for k in range(n)]
                yield pd.concat([part[kept].loc[part.index.repeat(counts)].reset_index(drop=True), pd.DataFrame(found, columns=made)], axis=1)

    return docs.select(*kept, text).mapInPandas(cut, schema)


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """The ids of each sequence: its pieces by offset, joined. A sequence holds no more than the capacity."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", F.col(ids).alias("ids")))), lambda p: p["ids"])
    joined: Column = F.aggregate(parts, F.lit(b""), lambda a, b: F.concat(a, b))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
