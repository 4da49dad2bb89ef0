"""Packing documents into sequences: an island grouping genetic algorithm.

A document is its token ids and an end id. Only longer ones are cut, into full
pieces and a rest; a full piece is a sequence of its own. The other pieces are
dealt at random into cells of about ``CELL_PIECES``; each cell is packed by
``ISLANDS`` independent populations, every one a Spark group:

* an individual is a list of bins (groups), not a list of places;
* *crossover* injects the well-filled bins of one parent whole into the other,
  removes the bins there that hold a document twice, and best-fits the displaced
  documents, longest first;
* *mutation* dissolves the emptiest and some random bins in the same way;
* after each round the best individual of every island *migrates* to the next
  island of its cell, by a shuffle of slim rows.

The fitness is the number of bins, then how unevenly they are filled (the sum of
squared fills): of two packings with as many bins, the one with more full ones leaves
more room together for pieces of other cells. An island stops when no packing can be
better: as few bins as the bound ceil(total / capacity), all full but one.

The best island of a cell counts. Bins that stay loose are dissolved over all
cells and packed again in new cells, as long as there are several cells and a pass
leaves at most half of its pieces in loose bins.

Defined results: a null or empty text is a piece of one end id; repeated rows
and null ids are packed row by row; an empty table gives no rows. Input columns
are kept in the struct ``row``, so their names never clash; a very long text is cut
into as many pieces as it needs; of equal lengths, any order may come first.
"""

from __future__ import annotations

import random
import zlib
from array import array
from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scoped_conf
from .common import TEXT_BATCHES, map_text, materialise, table
from .tokens import vocabulary_path, word_ids

CAPACITY = 4096
CELL_PIECES = 2048
ISLANDS, ROUNDS, POPULATION, GENERATIONS = 2, 2, 4, 12
#: a bin filled less than this is dissolved and packed again with those of other cells
LOOSE = 0.99


def cut_documents(docs: DataFrame, keep: list[str], path: str, text: str = "text", capacity: int = CAPACITY,
                  end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """``row, piece, start, length, ids_crc32`` (and ``ids``) of every piece."""
    end = array("I", [end_id]).tobytes()
    width = 4 * capacity

    def make():
        ids_of = word_ids(path).text_ids

        def cut(texts):
            pieces = []
            for t in texts:
                ids = ids_of(t) + end
                pieces.append([
                    {"piece": k, "start": at // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part),
                     "ids": array("I", part).tolist() if with_ids else None}
                    for k, at in enumerate(range(0, len(ids), width)) for part in (ids[at:at + width],)])
            return (pieces,)
        return cut

    cut = map_text(docs, text, keep, make,
                   "pieces array<struct<piece:int,start:long,length:long,ids_crc32:long,ids:array<int>>>")
    pieces = cut.select("row", F.inline("pieces"))
    return pieces if with_ids else pieces.drop("ids")


# ---- one island -------------------------------------------------------------------------------

def _best_fit(bins: list, rooms: list, items: list[int], size, capacity: int) -> None:
    """Put items, longest first, where least room is left. rooms: sorted (room, bin)."""
    for x in sorted(items, key=size.__getitem__, reverse=True):
        at = bisect_left(rooms, (size[x], -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
            bins[b].append(x)
        else:
            room, b = capacity, len(bins)
            bins.append([x])
        if room > size[x]:
            insort(rooms, (room - size[x], b))


def _packed(groups: list[list[int]], loose: list[int], size, capacity: int) -> list[list[int]]:
    bins = [list(g) for g in groups]
    rooms = sorted((capacity - sum(size[x] for x in g), b) for b, g in enumerate(bins))
    rooms = rooms[bisect_left(rooms, (1, -1)):]
    _best_fit(bins, rooms, loose, size, capacity)
    return bins


def _fitness(bins: list, size, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the more uneven fill."""
    return -len(bins), sum((sum(size[x] for x in b) / capacity) ** 2 for b in bins)


def _crossover(a: list, b: list, size, capacity: int, rng: random.Random) -> list:
    full = sorted(b, key=lambda g: -sum(size[x] for x in g))
    full = full[:max(1, len(full) // 2)]
    injected = rng.sample(full, max(1, len(full) // 2))
    taken = {x for g in injected for x in g}
    stay, loose = [], []
    for g in a:
        if taken.isdisjoint(g):
            stay.append(g)
        else:
            loose += [x for x in g if x not in taken]
    return _packed(injected + stay, loose, size, capacity)


def _mutated(a: list, size, capacity: int, rng: random.Random) -> list:
    order = sorted(range(len(a)), key=lambda i: sum(size[x] for x in a[i]))
    drop = set(order[:1 + len(a) // 20]) | set(rng.sample(range(len(a)), min(len(a), 1 + len(a) // 20)))
    return _packed([g for i, g in enumerate(a) if i not in drop], [x for i in drop for x in a[i]], size, capacity)


def _ideal(size: list[int], capacity: int) -> tuple[int, float]:
    """The fitness that no packing exceeds: full bins, and one for the rest."""
    full, rest = divmod(sum(size), capacity)
    return -(full + (rest > 0)), full + (rest / capacity) ** 2


def evolve(size: list[int], elites: list[list[list[int]]], seed: int, capacity: int = CAPACITY,
           counted: Counter | None = None) -> list[list[int]]:
    """The best bins found from the given elites and fresh individuals. counted: adds up ``crossovers``."""
    rng = random.Random(seed)
    ideal = _ideal(size, capacity)
    rank = lambda bins: _fitness(bins, size, capacity)
    done = lambda fitness: fitness[0] >= ideal[0] and fitness[1] > ideal[1] - 1e-9
    population = [(rank(e), e) for e in elites]
    while len(population) < POPULATION and not any(done(f) for f, _ in population):
        part = [] if not population else [x for x in range(len(size)) if rng.random() < 0.5]
        rest = set(range(len(size))).difference(part)
        bins = _packed(_packed([], part, size, capacity) if part else [], list(rest), size, capacity)
        population.append((rank(bins), bins))
    fitness = lambda individual: individual[0]
    best = max(population, key=fitness)
    for _ in range(GENERATIONS):
        if done(best[0]):
            break
        # the child takes the place of the worst, and only if it is better
        a, b = rng.sample(population, 2)
        bins = _mutated(_crossover(max(a, b)[1], min(a, b)[1], size, capacity, rng), size, capacity, rng)
        child, worst = (rank(bins), bins), min(population, key=fitness)
        if counted is not None:
            counted["crossovers"] += 1
        if child[0] > worst[0]:
            population[population.index(worst)] = child
        best = max(population, key=fitness)
    return best[1]


def _islands(capacity: int, seed: int):
    def island(rows: pd.DataFrame) -> pd.DataFrame:
        return _island(rows, capacity, seed)
    return island


def _island(rows: pd.DataFrame, capacity: int, seed: int) -> pd.DataFrame:
    """Rows of one (cell, island), once per elite they come with (``origin``; -1: none)."""
    first = rows.drop_duplicates("uid").sort_values("uid")
    index = {u: i for i, u in enumerate(first.uid)}
    elites = []
    for _, own in rows[rows.origin >= 0].groupby("origin"):
        groups: dict[int, list[int]] = {}
        for u, b in zip(own.uid, own.bin):
            groups.setdefault(b, []).append(index[u])
        elites.append(list(groups.values()))
    size = first.length.tolist()
    cell, island = int(first.cell.iloc[0]), int(first.island.iloc[0])
    bins = evolve(size, elites, hash((seed, cell, island, len(elites))), capacity)
    place = [0] * len(size)
    for b, group in enumerate(bins):
        for x in group:
            place[x] = b
    squares, used = [0] * len(bins), [0] * len(bins)
    for x, b in enumerate(place):
        used[b] += size[x]
    fill = sum((u / capacity) ** 2 for u in used)
    return first.assign(bin=place, used=[used[b] for b in place], n_bins=len(bins), fill=fill)


def _pack_cells(items: DataFrame, cells: int, seed: int, capacity: int) -> DataFrame:
    """``uid, length, cell, bin, used`` by the best island of each cell."""
    schema = "uid long, length long, cell long, island int, origin int, bin int, used long, n_bins int, fill double"
    state = (items.withColumn("cell", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(cells)))
             .withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
             .select("uid", "length", "cell", "island", F.lit(-1).alias("origin"), F.lit(0).alias("bin"),
                     F.lit(0).cast("long").alias("used"), F.lit(0).alias("n_bins"), F.lit(0.0).alias("fill")))
    for round_ in range(ROUNDS):
        if round_:  # every island keeps its best and gets the neighbour's
            moves = F.array(F.struct(F.col("island").alias("to"), F.lit(0).alias("o")),
                            F.struct(((F.col("island") + 1) % ISLANDS).alias("to"), F.lit(1).alias("o")))
            state = (state.withColumn("move", F.explode(moves))
                     .withColumn("island", F.col("move.to")).withColumn("origin", F.col("move.o")).drop("move"))
        state = state.groupBy("cell", "island").applyInPandas(_islands(capacity, seed + round_), schema)
    state = materialise(state, "islands")
    best = (state.groupBy("cell", "island").agg(F.first("n_bins").alias("n"), F.first("fill").alias("f"))
            .groupBy("cell").agg(F.max(F.struct((-F.col("n")).alias("n"), "f", "island")).alias("b"))
            .select("cell", "b.island"))
    return state.join(best, ["cell", "island"]).select("uid", "length", "cell", "bin", "used")


def pack(pieces: DataFrame, capacity: int = CAPACITY, seed: int = 5) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have a ``length`` of at most ``capacity``."""
    with scoped_conf(pieces.sparkSession, TEXT_BATCHES):
        pieces = materialise(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == capacity).select("uid", (-F.col("uid") - 1).alias("sequence_id"))
    items = pieces.where(F.col("length") < capacity).select("uid", "length")
    done, n, k = full, items.count(), 0
    while n:
        cells = -(-n // CELL_PIECES)
        packed = _pack_cells(items, cells, seed + 100 * k, capacity)
        loose = F.col("used") < LOOSE * capacity
        # one cell has no other to share its loose bins with; nor do pieces that seldom fill a bin gain from another
        left = packed.where(loose).count() if cells > 1 else 0
        again = loose if left and 2 * left <= n else F.lit(False)
        number = F.shiftleft(F.lit(k + 1).cast("long"), 56) + F.shiftleft("cell", 16) + F.col("bin")
        done = done.unionByName(packed.where(~again).select("uid", number.alias("sequence_id")))
        items = packed.where(again).select("uid", "length")
        n, k = left if 2 * left <= n else 0, k + 1
    before_it = Window.partitionBy("sequence_id").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    return (pieces.join(done, "uid")
            .withColumn("offset", F.coalesce(F.sum("length").over(before_it), F.lit(0))).drop("uid"))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` from pieces that carry their ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most `capacity` ids in a sequence
    return (packed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids")))


def pack_documents(docs: DataFrame, keep: list[str], path: str | None = None, text: str = "text",
                   capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``row, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``) of every piece."""
    return pack(cut_documents(docs, keep, path or vocabulary_path(), text, capacity, with_ids=with_ids), capacity)


def q_op4_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
