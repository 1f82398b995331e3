"""Problem 9: items of varying length packed into containers of fixed capacity.

Hierarchical multi-length packing: every item is routed to the shortest context tier that holds it (capacity, and its
halves down to a sixteenth). Each tier is packed by itself into windows of its own context size, best fit decreasing.
Then the gaps of the windows, those of the longest tier first, are filled with the largest items of shorter tiers that
fit. The windows of all tiers are laid into containers, longest first and each where it fits best, and what then stays
open is filled once more. Containers are dealt into step groups of equal size with the same share of each tier and
balanced attention cost. Items are spread by hash over shards of bounded size, which are packed apart; only the last
containers of a shard can stay open, so the loss does not grow with the number of items.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.session import cut

#: Items packed together in one task; a bound on a task's memory.
SHARD_ITEMS = 50_000
TIERS = 5
GROUP = 8
#: A container with less than this share of its capacity open is closed; the others' windows are opened again.
OPEN_SHARE = 1 / 256


def tier_of(sizes: np.ndarray, capacity: int, tiers: int = TIERS) -> np.ndarray:
    """The shortest tier (0: capacity, k: capacity / 2^k) that holds each size."""
    out = np.zeros(len(sizes), np.int32)
    for k in range(1, tiers):
        out[sizes <= capacity >> k] = k
    return out


class _Sizes:
    """Items of equal size on stacks, the sizes in order: the largest that fits a gap is found by bisection."""

    def __init__(self, sizes: np.ndarray, at: list[int]) -> None:
        self.stacks: dict[int, list[int]] = {}
        for i in reversed(at):
            self.stacks.setdefault(int(sizes[i]), []).append(i)
        self.order = sorted(self.stacks)

    def take(self, gap: int) -> tuple[int, int] | None:
        """(item, size) of the largest item of at most `gap`, which is taken away; None if there is none."""
        k = bisect_right(self.order, gap)
        if not k:
            return None
        size = self.order[k - 1]
        item = self.stacks[size].pop()
        if not self.stacks[size]:
            del self.stacks[size], self.order[k - 1]
        return item, size


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: items from large to small, each into the fullest bin that holds it."""
    bins: list[list[int]] = []
    gaps: list[tuple[int, int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        k = bisect_left(gaps, (sizes[i], -1))
        if k < len(gaps):
            gap, number = gaps.pop(k)
            bins[number].append(i)
        else:
            gap, number = capacity, len(bins)
            bins.append([i])
        insort(gaps, (gap - sizes[i], number))
    return bins


def pack(sizes: np.ndarray, capacity: int, tiers: int = TIERS) -> tuple[np.ndarray, np.ndarray]:
    """(container, window) of each item, both counted from 0; sizes must be within [0, capacity].

    Ties go to the item given first, so the result is deterministic. Items of size zero lie in the first window.
    """
    tier = tier_of(sizes, capacity, tiers)
    place = [np.flatnonzero((tier == k) & (sizes > 0)).tolist() for k in range(tiers)]
    windows: list[tuple[list[int], int, int]] = []
    shorter = [_Sizes(sizes, at) for at in place]
    for k in range(tiers):
        left = sorted(i for stack in shorter[k].stacks.values() for i in stack)
        shorter[k] = _Sizes(sizes, [])
        own = [[left[i] for i in one] for one in best_fit([int(sizes[i]) for i in left], capacity >> k)]
        for items in own:
            gap = (capacity >> k) - int(sizes[items].sum())
            for level in range(k + 1, tiers):
                while gap and (found := shorter[level].take(gap)):
                    items.append(found[0])
                    gap -= found[1]
            windows.append((items, (capacity >> k) - gap, k))
    container, window = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    laid = best_fit([fill for _, fill, _ in windows], capacity)
    # The windows of containers that stay open are opened again: their items fill the gaps of the others.
    loads = [sum(windows[w][1] for w in one) for one in laid]
    full = [load >= capacity * (1 - OPEN_SHARE) for load in loads]
    spare = _Sizes(sizes, sorted(i for c, one in enumerate(laid) if not full[c] for w in one for i in windows[w][0]))
    number = count = 0
    for c in sorted((c for c in range(len(laid)) if full[c]), key=lambda c: loads[c]):
        for w in laid[c]:
            container[windows[w][0]], window[windows[w][0]] = count, number
            number += 1
        gap = capacity - loads[c]
        while gap and (found := spare.take(gap)):
            container[found[0]], window[found[0]] = count, number
            number, gap = number + 1, gap - found[1]
        count += 1
    rest = sorted(i for stack in spare.stacks.values() for i in stack)
    for one in best_fit([int(sizes[i]) for i in rest], capacity):
        for i in one:
            container[rest[i]], window[rest[i]] = count, number
            number += 1
        count += 1
    return container, window


def balanced_groups(costs: np.ndarray, kinds: np.ndarray, group: int = GROUP) -> np.ndarray:
    """Step group of each container: containers are dealt back and forth over the groups, kind by kind and the costliest
    first, so that every group has the same number of each kind (give or take one) and about the same cost."""
    groups = max(1, -(-len(costs) // group))
    order = np.lexsort((-costs, kinds))
    turn, place = np.divmod(np.arange(len(costs)), groups)
    out = np.empty(len(costs), np.int64)
    out[order] = np.where(turn % 2 == 0, place, groups - 1 - place)
    return out


def items(sizes: DataFrame, capacity: int, key: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """key, part_no, start, size: one item per row of `sizes`, and one per `capacity` tokens of a row that exceeds it."""
    n = F.coalesce(F.col(size), F.lit(0)).cast("int")
    parts = F.greatest(F.ceil(n / capacity), F.lit(1)).cast("int")
    spread = sizes.select(F.col(key), n.alias("__n"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part_no"))
    start = (F.col("part_no") * capacity).alias("start")
    return spread.select(key, "part_no", start, F.least(F.lit(capacity), F.col("__n") - F.col("part_no") * capacity).alias("size"))


def pack_items(sizes: DataFrame, capacity: int, key: str = "doc_id", size: str = "n_tokens", group: int = GROUP) -> DataFrame:
    """key, part_no, start, size, tier, container_id, window_id, fill (of the container), step_group.

    Every row of `sizes` (key, size) comes out; null sizes count as zero. No item is split unless it exceeds the
    capacity; the parts of one that does are consecutive ranges. container_id, window_id and step_group are unique
    over all shards; an item attends to its own window only.
    Ties are broken by key and part, so that a rerun gives the same containers. An empty input gives no rows.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    small = cut(sizes.select(key, size))
    shards = max(1, -(-small.count() // SHARD_ITEMS))
    spread = items(small, capacity, key, size).withColumn("shard", F.pmod(F.xxhash64(key, "part_no"), F.lit(shards)).cast("int"))
    kind = spread.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, part_no int, start int, size int, tier int, container_id bigint, window_id bigint, fill int, step_group bigint"

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([key, "part_no"], kind="stable").reset_index(drop=True)
        numbers = frame["size"].to_numpy(np.int64)
        container, window = pack(numbers, capacity)
        loads = np.bincount(container, weights=numbers).astype(np.int64)
        tier = tier_of(numbers, capacity)
        # Attention costs the square of a window's length; a container is of the kind of its longest tier.
        spans, kinds = np.bincount(window, weights=numbers), np.full(len(loads), TIERS)
        cost = np.zeros(len(loads))
        first = np.unique(window, return_index=True)[1]
        np.add.at(cost, container[first], spans[window[first]] ** 2)
        np.minimum.at(kinds, container, tier)
        base = int(frame["shard"].iloc[0]) << 32
        frame["tier"] = tier
        frame["container_id"] = base + container
        frame["window_id"] = base + window
        frame["fill"] = loads[container]
        frame["step_group"] = base + balanced_groups(cost, kinds, group)[container]
        return frame[[key, "part_no", "start", "size", "tier", "container_id", "window_id", "fill", "step_group"]]

    return spread.groupBy("shard").applyInPandas(run, schema)


def packing_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, tokens, share of unused space, and the spread of the step groups' loads."""
    containers = packed.groupBy("container_id", "step_group").agg(F.sum("size").alias("load"))
    groups = containers.groupBy("step_group").agg(F.sum("load").alias("tokens"), F.count("*").alias("n"))
    totals = groups.agg(F.sum("n").alias("containers"), F.sum("tokens").alias("tokens"), F.min(F.col("tokens") / F.col("n")).alias("lightest_mean"), F.max(F.col("tokens") / F.col("n")).alias("heaviest_mean"))
    unused = F.when(F.col("containers") > 0, 1 - F.col("tokens") / (F.col("containers") * capacity))
    return totals.select("containers", "tokens", F.round(unused, 6).alias("unused"), F.round("lightest_mean", 3).alias("lightest_mean"), F.round("heaviest_mean", 3).alias("heaviest_mean"))
