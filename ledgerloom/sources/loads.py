"""Tables that hold one part per load of another table, and are caught up with it.

A part is worked out from one load alone and stored under that load's number. What a lost job has left out is
found by comparing numbers, so the two tables never drift apart: the next run works out the parts that are missing.
When there are many parts they are folded into one, which then stands for all loads up to its number; likewise a
compacted table holds all its earlier loads under the number of the last one.

Small loads are merged by size: a load belongs to a tier, each ``fan_in`` times as large as the one below, and where
neighbours of no higher tier hold ``fan_in`` loads of one tier, they become one load. A row is so written again once
per tier, not with every merge, and of loads of like size fewer than ``fan_in`` stay in each tier.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, types as T

from ledgerloom.sources.tables import TableStore

MOST_PARTS = 16
FAN_IN = 8
SMALL_BYTES = 64 << 20


def newest(store: TableStore, layer: str, table: str) -> tuple[int, list[int]]:
    """Current version, 0 when there is none, and the numbers of its loads."""
    loads = store.loads(layer, table)
    version = loads[-1][0] if loads else 0
    return version, [load for number, load in loads if number == version]


def missing(store: TableStore, layer: str, parts: str, loads: Sequence[int]) -> list[int]:
    """Those of ``loads`` that have no part yet. The first part of a later version stands for all before it."""
    version, known = newest(store, layer, parts)
    folded = known[0] if version > 1 else -1
    return [load for load in loads if load > folded and load not in known]


def catch_up(
    store: TableStore,
    layer: str,
    parts: str,
    loads: Sequence[int],
    make: Callable[[int], DataFrame],
    merge: Callable[[DataFrame], DataFrame] | None = None,
    most: int = MOST_PARTS,
) -> list[int]:
    """Store ``make(load)`` for every load without a part, and fold the parts by ``merge`` when there are too many."""
    added = missing(store, layer, parts, loads)
    for load in added:
        store.append(layer, parts, make(load), load=load)
    _, known = newest(store, layer, parts)
    if merge is not None and len(known) > most:
        store.replace(layer, parts, merge(store.read(layer, parts)), load=known[-1])
    return added


def tier_of(size: int, fan_in: int = FAN_IN, small_bytes: int = SMALL_BYTES) -> int:
    """0 up to ``small_bytes``, and one more for every ``fan_in`` times that."""
    tier = 0
    while size > small_bytes:
        size, tier = size / fan_in, tier + 1
    return tier


def to_merge(tiers: Sequence[int], fan_in: int = FAN_IN) -> tuple[int, int] | None:
    """The neighbours, from one place up to before another, that become one load next; None when none do."""
    for tier in sorted(set(tiers)):
        start = 0
        for end in range(len(tiers) + 1):
            if end == len(tiers) or tiers[end] > tier:
                if list(tiers[start:end]).count(tier) >= fan_in:
                    return start, end
                start = end + 1
    return None


def merge_small(
    store: TableStore,
    layer: str,
    table: str,
    schema: T.StructType | None = None,
    partition_by: Sequence[str] = (),
    upto: int | None = None,
    fan_in: int = FAN_IN,
    small_bytes: int = SMALL_BYTES,
) -> list[tuple[int, int]]:
    """Merge small neighbouring loads of the current version up to number ``upto``; first and last number of each merge.

    The loads that were merged stay on disk for jobs that still read them, until ``store.drop_merged``.
    """
    if fan_in < 2:
        raise ValueError("fewer than two loads cannot be merged")
    merged = []
    with store.claim(f"{layer}/{table}/merge"):
        sizes: dict[tuple[int, int, int], int] = {}
        while True:
            ranges = store.ranges(layer, table)
            ranges = [of for of in ranges if of[0] == ranges[-1][0] and (upto is None or of[2] <= upto)]
            for of in ranges:
                sizes[of] = sizes[of] if of in sizes else store.load_bytes(layer, table, *of)
            found = to_merge([tier_of(sizes[of], fan_in, small_bytes) for of in ranges], fan_in)
            if found is None:
                return merged
            first, last = ranges[found[0]][1], ranges[found[1] - 1][2]
            store.merge(layer, table, first, last, schema, partition_by)
            merged.append((first, last))
