"""Keys of a table found by partition refinement, and inclusions between tables found level by level.

A column set is unique when no two rows agree on it. What a failed set teaches is kept: the rows
that still share their values with another row (its stripped partition), as supersets can only
fail there, and the sets of columns on which two such rows agree (agree sets), as none of their
subsets is a key.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import combinations, product
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablebridge.model import QueryError
from tablebridge.operators.verify import cell_text, length_prefixed
from tablebridge.session import stage
from tablebridge.sources.scan import col, require_columns

SKETCH_ERROR = 0.02
SAFE_SHARE = 0.8  # ten standard errors below: no true key is ever pruned
SKETCHES_PER_PASS = 64
STRIPPED_SHARE = 0.05  # of the rows; a set that leaves more in doubt keeps no partition of its own
AGREE_SETS = 4_096  # of a width that come to the driver, widest first; they only spare work
PAIRED_ROWS = 512  # all pairs of so many rows are compared before any set is judged
WITNESS_ROOTS = 64  # the witnesses are so many times the square root of the rows
BROADCAST_REPEATS = 1 << 20  # rows in doubt whose hashes travel to every task, by their count
HASHES_PER_TASK = 1 << 20  # of rows and sets that are judged

Places = frozenset  # the numbers of the columns of a set


def _cells(places: Iterable[int]) -> list[Column]:
    return [F.col(f"c{i}") for i in sorted(places)]


def _keyed(rows: DataFrame, sets: dict[int, Places], parents: dict[int, int]) -> DataFrame:
    """Each row once for each set it has to be judged by, as ``set``, ``h`` and its columns."""
    items = F.array(*[F.struct(F.lit(n).alias("set"), F.xxhash64(*_cells(s)).alias("h"), F.lit(parents.get(n, -1)).alias("parent"))
                      for n, s in sets.items()])
    if not parents:
        return rows.select("*", F.inline(items)).drop("parent")
    own = rows.where(F.col("set").isin(sorted(set(parents.values())))).withColumnRenamed("set", "of").drop("h")
    return own.select("*", F.inline(F.filter(items, lambda x: x["parent"] == F.col("of")))).drop("of", "parent")


def _repeats(keyed: DataFrame, hashes: int) -> DataFrame:
    """Each ``set`` and ``h`` of several rows, with their number. Hardly any rows meet, so none are merged before the shuffle."""
    dealt = keyed.select("set", "h").repartition(1 + hashes // HASHES_PER_TASK, "set", "h")
    return dealt.groupBy("set", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _classes(stripped: DataFrame, sets: dict[int, Places], places: Sequence[int]) -> DataFrame:
    """``set``, ``agreeing``, the columns on which the ends of a class of equal values agree, and ``n``, the rows of such classes."""
    masked = [F.when(F.col("set").isin([n for n, s in sets.items() if i in s]), F.col(f"c{i}")).alias(f"m{i}") for i in places]
    whole = F.struct(*_cells(places))
    ends = (stripped.groupBy("set", *masked).agg(F.count(F.lit(1)).alias("n"), F.min(whole).alias("lo"), F.max(whole).alias("hi"))
            .where("n > 1"))
    return ends.groupBy("set", _agreeing("lo", "hi", places)).agg(F.sum("n").alias("n"))


def _agreeing(left: str, right: str, places: Sequence[int]) -> Column:
    return F.concat_ws(",", *[F.when(F.col(left)[f"c{i}"].eqNullSafe(F.col(right)[f"c{i}"]), F.lit(str(i))) for i in places]).alias("agreeing")


class _Refinement:
    """What is known of a table's column sets while their width grows."""

    def __init__(self, base: DataFrame, places: Sequence[int], total: int) -> None:
        self.base, self.places, self.total = base, places, total
        self.found: list[Places] = []
        self.agree: list[Places] = []
        self.staged: dict[Places, tuple[int, int]] = {}  # set to its number and its rows in doubt
        self.frames: list[DataFrame] = []
        self.next = 0
        self.few = max(STRIPPED_SHARE * total, 1_000)
        self.every = max(1, int(total ** 0.5 / WITNESS_ROOTS))
        self.witnesses = self.chosen(base, self.every) if self.every > 1 else base
        if places and total > 1:
            self.pair()

    def chosen(self, rows: DataFrame, every: int) -> DataFrame:
        """One in ``every`` rows, by a hash of the whole row."""
        return stage(rows.where(F.pmod(F.xxhash64(F.lit("witness"), *_cells(self.places)), F.lit(every)) == 0), "witnesses")

    def pair(self) -> None:
        """Learn from all pairs of some rows."""
        some = self.witnesses.limit(PAIRED_ROWS).select(F.monotonically_increasing_id().alias("id"), F.struct(*_cells(self.places)).alias("row"))
        some = stage(some, "paired")
        both = some.toDF("a", "left").join(some.toDF("b", "right"), F.col("a") < F.col("b"))
        self.learn(both.select(_agreeing("left", "right", self.places)).where("agreeing <> ''"))

    def learn(self, agreeing: DataFrame) -> None:
        widest = agreeing.select("agreeing").distinct().orderBy(F.size(F.split("agreeing", ",")).desc(), "agreeing").limit(AGREE_SETS)
        for r in widest.collect():
            seen = frozenset(int(i) for i in r.agreeing.split(","))
            if not any(seen <= a for a in self.agree):
                self.agree.append(seen)

    def open(self, width: int) -> list[Places]:
        sets = (frozenset(s) for s in combinations(self.places, width))
        return [s for s in sets if not any(k <= s for k in self.found) and not any(s <= a for a in self.agree)]

    def source(self, s: Places) -> int | None:
        """The number of the smallest partition of a subset."""
        own = [v for k, v in self.staged.items() if k < s]
        return min(own, key=lambda v: v[1])[0] if own else None

    def hopeful(self, sets: list[Places]) -> list[Places]:
        """The sets but those of which so many witnesses agree that no partition would be kept of them.

        Two rows that agree on a set prove that it is no key; of pairs of rows one in the square of ``every`` is seen.
        The agree sets of witnesses are not learned: they would also close sets whose partitions spare their supersets.
        """
        if self.every == 1 or not sets:
            return sets
        numbers = dict(enumerate(sets))
        keyed = _keyed(self.witnesses, numbers, {})
        repeats = keyed.groupBy("set", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("set", "h")
        classes = stage(_classes(keyed.join(repeats, ["set", "h"], "left_semi"), numbers, self.places), "seen")
        seen = {r["set"]: r.seen for r in classes.groupBy("set").agg(F.sum("n").alias("seen")).collect()}
        return [s for n, s in numbers.items() if seen.get(n, 0) * self.every ** 2 <= self.few]

    def judge(self, width: int) -> None:
        sets = self.open(width)
        parents = {s: self.source(s) for s in sets}
        refined = [s for s in sets if parents[s] is not None]
        hopeful = self.hopeful([s for s in sets if parents[s] is None])
        numbers = {s: self.next + i for i, s in enumerate(refined + hopeful)}
        self.next += len(numbers)
        parts = []
        if refined:
            by_number = {numbers[s]: s for s in refined}
            parts.append(_keyed(reduce(DataFrame.unionByName, self.frames), by_number, {numbers[s]: parents[s] for s in refined}))
        if hopeful:
            parts.append(_keyed(self.base, {numbers[s]: s for s in hopeful}, {}))
        if parts:
            doubts = {n: d for n, d in self.staged.values()}
            hashes = len(hopeful) * self.total + sum(doubts[parents[s]] for s in refined)
            self.refine(reduce(DataFrame.unionByName, parts), {n: s for s, n in numbers.items()}, hashes)

    def stripped(self, keyed: DataFrame, repeats: DataFrame, doubts: dict[int, int]) -> list[DataFrame]:
        """The rows in doubt; the sets with the fewest are looked up in each task, so that no row of theirs is shuffled."""
        near, wide, left = [], [], BROADCAST_REPEATS
        for n in sorted(doubts, key=doubts.__getitem__):
            (near if doubts[n] <= left else wide).append(n)
            left -= doubts[n]
        parts = []
        for numbers, hint in ((near, F.broadcast), (wide, lambda df: df)):
            if numbers:
                wanted = F.col("set").isin(sorted(numbers))
                own = keyed.where(wanted).join(hint(repeats.where(wanted).select("set", "h")), ["set", "h"], "left_semi")
                parts.append(stage(own, "stripped"))
        return parts

    def refine(self, keyed: DataFrame, sets: dict[int, Places], hashes: int) -> None:
        """Sort the sets into keys, sets with few rows in doubt, whose rows are kept, and the rest."""
        repeats = stage(_repeats(keyed, hashes), "repeats")
        doubts = {r["set"]: r.doubt for r in repeats.groupBy("set").agg(F.sum("n").alias("doubt")).collect()}
        self.found += [s for n, s in sets.items() if n not in doubts]
        few = {n: sets[n] for n, d in doubts.items() if d <= self.few}
        if not few:
            return
        stripped = self.stripped(keyed, repeats, {n: doubts[n] for n in few})
        classes = stage(_classes(reduce(DataFrame.unionByName, stripped), few, self.places), "agreeing")
        failed = {r["set"] for r in classes.select("set").distinct().collect()}
        self.found += [s for n, s in few.items() if n not in failed]  # their hashes alone were equal
        self.staged.update({few[n]: (n, doubts[n]) for n in failed})
        self.frames += stripped
        self.learn(classes)


def discover_keys(df: DataFrame, max_width: int = 2, columns: Sequence[str] | None = None) -> DataFrame:
    """Minimal column sets that are unique and free of NULL, up to ``max_width`` columns.

    Two rows that agree on a set prove that it is no key, so sets are first tried on witnesses, some
    of the rows that grow with the square root of the table: a set on which many of them agree is
    dropped. What is left of a width is judged in one job over all rows that
    shuffles a hash for each row and set: a set without equal hashes is a key. Where few rows have
    equal hashes they are compared by value, written, and become the table for all supersets;
    the columns on which they agree rule out further sets. The result is exact. Supersets of a
    key are not listed; of a table with at most one row every column without NULL is a key.
    """
    orderable = [f.name for f in df.schema.fields
                 if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    names = require_columns(df, columns) if columns else orderable
    base = df.select(*[col(c).alias(f"c{i}") for i, c in enumerate(names)])
    cells = _cells(range(len(names)))
    first = base.agg(F.count(F.lit(1)), *[F.count_if(c.isNull()) for c in cells]).first()
    total, nulls = first[0], first[1:]
    places = [i for i, n in enumerate(nulls) if n == 0]
    state = _Refinement(base.select(*_cells(places)), places, total)
    for width in range(1, min(max_width, len(places)) + 1):
        if any(len(a) == len(places) for a in state.agree):
            break  # two rows are the same
        state.judge(width)
    rows = [(",".join(names[i] for i in sorted(s)), len(s)) for s in sorted(state.found, key=lambda s: (len(s), sorted(s)))]
    return df.sparkSession.createDataFrame(rows, "key_columns string, width int")


class _Item(NamedTuple):
    """Some columns of a table, in the order of an inclusion."""

    table: str
    columns: tuple[str, ...]

    def label(self) -> str:
        return ",".join(f"{self.table}.{c}" for c in self.columns)


class _Facts(NamedTuple):
    family: str
    least: Any
    most: Any
    distinct: int


def _family(data_type: T.DataType) -> str | None:
    """Columns of one family compare by their text; floating point numbers are no references."""
    if isinstance(data_type, T.IntegralType):
        return "integer"
    if isinstance(data_type, T.StringType):
        return "text"
    if isinstance(data_type, (T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)):
        return data_type.simpleString()
    return None


def _profile(tables: Mapping[str, DataFrame]) -> dict[_Item, _Facts]:
    """Range and sketched distinct values of every column that can take part, one pass for each table."""
    facts = {}
    for name, df in tables.items():
        fields = [(f.name, f.dataType, _family(f.dataType)) for f in df.schema.fields if _family(f.dataType)]
        if not fields:
            continue
        aggs: list[Column] = []
        for c, data_type, family in fields:
            x = col(c)
            # Text stays text; other types compare on the driver as numbers, or not at all.
            place = {"integer": x.cast("bigint"), "text": x, "date": F.unix_date(x) if family == "date" else None,
                     "timestamp": F.unix_micros(x) if family == "timestamp" else None}.get(family)
            place = F.lit(None).cast("string") if place is None else place
            aggs += [F.min(place), F.max(place), F.approx_count_distinct(x, SKETCH_ERROR)]
        row = df.agg(*aggs).first()
        for i, (c, _, family) in enumerate(fields):
            facts[_Item(name, (c,))] = _Facts(family, *row[3 * i:3 * i + 3])
    return facts


def _may_include(child: _Facts, ref: _Facts, whole: bool) -> bool:
    """Whether ranges allow that all (``whole``) or some of the child's values occur in the other column."""
    if child.family != ref.family or not child.distinct or not ref.distinct:
        return False
    if child.least is None or ref.least is None:
        return True
    if whole:
        return ref.least <= child.least and child.most <= ref.most
    return child.least <= ref.most and ref.least <= child.most


def _may_reach(child: int, ref: int, ratio: float) -> bool:
    """Whether sketches allow that ``ratio`` of the child's values find one each."""
    return ref / SAFE_SHARE >= ratio * child * SAFE_SHARE


def _sketched(tables: Mapping[str, DataFrame], items: Iterable[_Item]) -> dict[_Item, int]:
    out = {}
    for name, df in tables.items():
        own = [i for i in items if i.table == name]
        for start in range(0, len(own), SKETCHES_PER_PASS):
            some = own[start:start + SKETCHES_PER_PASS]
            whole = [F.when(reduce(Column.__and__, [col(c).isNotNull() for c in i.columns]), F.xxhash64(*[col(c) for c in i.columns])) for i in some]
            out.update(zip(some, df.agg(*[F.approx_count_distinct(w, SKETCH_ERROR) for w in whole]).first()))
    return out


def _shared(tables: Mapping[str, DataFrame], pairs: Sequence[tuple[_Item, _Item]]) -> dict[tuple[_Item, _Item], int]:
    """How many distinct values of the first item of each pair occur in the second.

    Each value meets itself once, with a bit for each item that holds it; copies are merged before
    the shuffle. The bit patterns are counted, and pairs are formed from counted patterns alone.
    """
    items = sorted({i for p in pairs for i in p})
    bits = {item: divmod(n, 62) for n, item in enumerate(items)}
    words = [f"w{n}" for n in range(max(n for n, _ in bits.values()) + 1)]
    cells = []
    for name, df in tables.items():
        own = [i for i in items if i.table == name]
        if not own:
            continue
        rows = []
        for item in own:
            texts = [cell_text(col(c), df.schema[c].dataType) for c in item.columns]
            value = texts[0] if len(texts) == 1 else F.concat(*[F.when(t.isNotNull(), length_prefixed(t)) for t in texts])
            word, bit = bits[item]
            rows.append(F.struct(value.alias("value"), *[F.lit(1 << bit if n == word else 0).cast("bigint").alias(w) for n, w in enumerate(words)]))
        cells.append(df.select(F.inline(F.array(*rows))).where("value IS NOT NULL"))
    merged = reduce(DataFrame.unionAll, cells).groupBy("value").agg(*[F.bit_or(w).alias(w) for w in words])
    patterns = stage(merged.groupBy(*words).agg(F.count(F.lit(1)).alias("n")), "patterns")
    held = []
    for n, (a, b) in enumerate(pairs):
        both = reduce(Column.__and__, [F.col(words[w]).bitwiseAND(F.lit(1 << bit)) != 0 for w, bit in {bits[a], bits[b]}])
        held.append(F.when(both, F.lit(n)))
    counts = (patterns.select("n", F.explode(F.array_compact(F.array(*held))).alias("pair"))
              .groupBy("pair").agg(F.sum("n").alias("shared")))
    found = {r.pair: r.shared for r in counts.collect()}  # a number for each pair of columns
    return {p: found.get(n, 0) for n, p in enumerate(pairs)}


def _wider(held: set[tuple[_Item, _Item]], width: int) -> list[tuple[_Item, _Item]]:
    """Pairs of ``width`` columns whose every narrower part is in ``held``."""
    columns: dict[tuple[str, str], set[tuple[str, str]]] = {}
    for child, ref in held:
        columns.setdefault((child.table, ref.table), set()).update(zip(child.columns, ref.columns))
    out = []
    for (table, other), links in columns.items():
        targets: dict[str, list[str]] = {}
        for c, r in sorted(links):
            targets.setdefault(c, []).append(r)
        for cs in combinations(sorted(targets), width):
            for rs in product(*[targets[c] for c in cs]):
                if len(set(rs)) == width and all((_Item(table, cs[:i] + cs[i + 1:]), _Item(other, rs[:i] + rs[i + 1:])) in held for i in range(width)):
                    out.append((_Item(table, cs), _Item(other, rs)))
    return out


def discover_inclusions(tables: Mapping[str, DataFrame], max_width: int = 1, min_ratio: float = 1.0,
                        references: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Columns whose values, as single values or as tuples, occur in columns of a table.

    Rows are ``col_names``, ``ref_names``, ``width``, ``distinct_values`` of the first, how many of
    them are ``shared``, and their ``ratio``, where it is above zero and at least ``min_ratio``.
    Tuples with a NULL are left out, as in a foreign key; a column is not compared with itself.
    Tuples list their own columns by name. ``references`` names the columns that may be referred to.

    Types, ranges and sketches rule pairs out before any value moves. A wider pair is tried where
    all its parts are inclusions, or for a ratio below 1, where they share a value at all, as
    columns may share fewer values than their tuples do.
    """
    if not tables or not 0 < min_ratio <= 1:
        raise QueryError("there must be a table, and the ratio must be above 0 and at most 1")
    facts, rows = _profile(tables), []
    allowed = {i for i in facts if references is None or i.columns[0] in references.get(i.table, ())}
    whole = min_ratio == 1
    pairs = [(a, b) for a in sorted(facts) for b in sorted(allowed) if a != b and _may_include(facts[a], facts[b], whole)]
    sizes = {i: f.distinct for i, f in facts.items()}
    for width in range(1, max_width + 1):
        if width > 1:
            pairs = _wider(held, width)
            sizes = _sketched(tables, {i for p in pairs for i in p})
        # For wider pairs of a partial inclusion any shared value counts, so all pairs but the last width's are counted.
        if whole or width == max_width:
            pairs = [(a, b) for a, b in pairs if _may_reach(sizes[a], sizes[b], min_ratio)]
        if not pairs:
            break
        counts = _shared(tables, pairs + [(a, a) for a in sorted({a for a, _ in pairs})])
        held = {p for p in pairs if counts[p] > 0 and (not whole or counts[p] == counts[p[0], p[0]])}
        rows += [(a.label(), b.label(), width, counts[a, a], counts[a, b], counts[a, b] / counts[a, a])
                 for a, b in pairs if (a, b) in held and counts[a, b] >= min_ratio * counts[a, a]]
    one = next(iter(tables.values()))
    return one.sparkSession.createDataFrame(rows, "col_names string, ref_names string, width int, distinct_values bigint, shared bigint, ratio double")
