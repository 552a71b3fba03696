"""Keyed stream state: window ends, first readings, newest times and formula versions.

Each operator turns a stream of rows into a stream of results and keeps what it needs per key in Spark's state
store, with the life that the data model gives it.  Lives are of processing time, so no device's clock ages
another's state.  What can be combined is combined before the shuffle, so that a hot key reaches its task as few
rows; a key that stays hot is salted, or bounded by what the source admits to a micro-batch.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, BooleanType, StringType, StructField, StructType

from wattline.functions.expressions import OPS
from wattline.functions.numbers import subtract
from wattline.operators.calibration import compile_formulas
from wattline.operators.provisioning import unregistered
from wattline.operators.usage import WINDOW, usage_documents
from wattline.operators.windows import assign_closed_windows, with_seconds
from wattline.schemas import STEP_SECONDS, USAGE_STEPS
from wattline.streaming import packs

HOUR_MS = 3_600_000
# Lives of the state. Window ends: from a window's last update; first readings: from the first one;
# newest times: from the feed's last reading.
WINDOW_LIFE_MS, FIRST_SEEN_LIFE_MS, NEWEST_LIFE_MS = 35 * 24 * HOUR_MS, 3 * HOUR_MS, 36 * HOUR_MS
# Superseded formulas stay so long for readings that come late.
SUPERSEDED_LIFE_MS = 36 * HOUR_MS
# Groups that feeds are kept in, and seconds of the spans that their shorter windows are kept by.
FEED_GROUPS, SPAN_SECONDS = 32, 6 * 3600
# Tasks that the readings of one input are spread over.
FORMULA_SALTS = 8
# Groups that inputs are kept in, and the parts of a group that are read and written by themselves.
INPUT_GROUPS, INPUT_PARTS = 32, 64

Frames = Iterator[pd.DataFrame]
Rows = Iterator[Row]
_ENDS = [f"{e}_{c}" for e in ("first", "last") for c in ("t", "arrival", "value")]
_BY = ["feeds", "span", *WINDOW]
# When a window of this micro-batch was updated, and windows in a pack of results.
_FRESH, _PACKED_OUT = 2**63 - 1, 1 << 16
_FORMULA = ["part", "input_id", "version", "val_feed_id", "ops"]


def _schema(rows: DataFrame, *columns: str) -> StructType:
    return StructType([StructField(c, rows.schema[c].dataType) for c in columns])


def _widest(rows: pa.Table, by: tuple[str, ...] = ()) -> pa.Table:
    """One row per window, sorted by ``by``: both ends of its rows; of equal times the later arrival."""
    keys = {"k": packs.joint_codes(rows, [*by, "feed_id", "step"]), "ws": rows["ws"]}
    first = packs.sort_order(keys | {c: rows[c] for c in _ENDS[:2]}, descending=("first_arrival",))
    last = packs.sort_order(keys | {c: rows[c] for c in _ENDS[3:5]})
    # Both orders have the same windows in the same places.
    starts = packs.run_starts(keys["k"][first], rows["ws"].to_numpy()[first])
    columns = [c for c in rows.column_names if c not in _ENDS[3:]]
    found = rows.select(columns).take(first[starts])
    ends = rows.select(_ENDS[3:]).take(last[np.append(starts[1:], len(last))[: len(starts)] - 1])
    found = {c: found[c] for c in columns} | {c: ends[c] for c in _ENDS[3:]}
    if "updated" in columns and len(starts):
        found["updated"] = np.maximum.reduceat(rows["updated"].to_numpy()[first], starts)
    return pa.table(found).select(rows.column_names).combine_chunks()


class _WindowEnds(StatefulProcessor):
    """Both ends of the windows of a feed, or of many feeds, each with a life of its own.

    They are one value in the state, which a micro-batch reads and writes once: ``updated`` tells when a window was
    last revised.  The life of the whole value starts with its last update, so nothing is kept beyond the last window's.
    """

    def __init__(self, ends: StructType | None, life_ms: int):
        self.schema, self.life_ms = ends, life_ms
        self.found = Row(*WINDOW, "first_value", "last_value")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ends = handle.getValueState("ends", "windows binary", self.life_ms)

    def revised(self, fresh: pa.Table, now: int) -> pa.Table:
        """The windows of ``fresh`` with the readings before them, which are kept with them."""
        rows = pa.table({c: fresh[c] for c in fresh.column_names} | {"updated": np.full(fresh.num_rows, _FRESH)})
        known = self.ends.get()
        if known is not None:
            earlier = packs.unpack(known[0])
            rows = pa.concat_tables([earlier.filter(pa.array(now - earlier["updated"].to_numpy() < self.life_ms)), rows])
        rows = _widest(rows)
        updated = rows["updated"].to_numpy()
        kept = {c: rows[c] for c in rows.column_names} | {"updated": np.where(updated == _FRESH, now, updated)}
        self.ends.update((packs.pack(pa.table(kept)),))
        return rows.filter(pa.array(updated == _FRESH))

    def handleInputRows(self, key, rows, timerValues) -> Rows:
        fresh = pa.Table.from_pylist([{"feed_id": key[0]} | {c: r[c] for c in ("step", "ws", "we", *_ENDS)} for r in rows])
        for r in self.revised(fresh, timerValues.getCurrentProcessingTimeInMs()).to_pylist():
            yield self.found(*(r[c] for c in self.found))


class _PackedWindowEnds(_WindowEnds):
    """The same with windows that come and go in packs."""

    def handleInputRows(self, key, rows, timerValues) -> Rows:
        held, size, most = [], 0, packs.PACK_BYTES
        for r in rows:
            held.append(packs.unpack(r["windows"]))
            size += held[-1].nbytes
            if size > most:
                held = [_widest(pa.concat_tables(held).combine_chunks())]
                size = held[0].nbytes
                most = max(packs.PACK_BYTES, 2 * size)
        found = self.revised(pa.concat_tables(held).combine_chunks(), timerValues.getCurrentProcessingTimeInMs())
        for part in found.select([*self.found]).to_batches(max_chunksize=_PACKED_OUT):
            yield Row(windows=packs.pack(pa.Table.from_batches([part])))


def _combined(batches: packs.Batches) -> packs.Batches:
    """The ends of windows as far as a task's rows lie together, in packs by group and span."""
    for rows in packs.buffered(batches):
        ends = {f"{e}_{c}": rows[c] for e in ("first", "last") for c in ("t", "arrival", "value")}
        table = _widest(pa.table({c: rows[c] for c in _BY} | ends), ("feeds", "span"))
        if (batch := packs.packed_runs(table, ["feeds", "span"], "windows")) is not None:
            yield batch


def usage_stream(readings: DataFrame, steps: list[str] = USAGE_STEPS, life_ms: int = WINDOW_LIFE_MS, groups: int = FEED_GROUPS) -> DataFrame:
    """Usage documents of grid readings, each as often as its window is revised (update mode).

    All steps come from one pass over the readings.  A window lives for ``life_ms`` from its last update; a
    late reading revises it until then and starts it anew after that.  Feeds are dealt to ``groups``; the windows of
    a group are kept together by spans of six hours, those of a day and longer by themselves, so a feed is spread
    over its days.  A micro-batch reads and writes the groups and spans its readings fall into, as whole columns.
    """
    start = F.col("ws")
    short = [s for s in steps if STEP_SECONDS.get(s, SPAN_SECONDS) < SPAN_SECONDS]
    span = F.concat(F.when(F.col("step").isin(short), "").otherwise(F.col("step")), F.lit("@"), start - F.pmod(start, F.lit(SPAN_SECONDS)))
    group = F.pmod(F.xxhash64("feed_id"), F.lit(groups)).cast("int")
    windows = assign_closed_windows(readings, steps).select(group.alias("feeds"), span.alias("span"), *WINDOW, "t", "arrival", "value")
    kept = StructType([*_schema(windows, "feeds", "span"), StructField("windows", BinaryType())])
    combined = windows.mapInArrow(_combined, kept)
    found = combined.groupBy("feeds", "span").transformWithState(
        _PackedWindowEnds(None, life_ms), StructType([kept["windows"]]), "Update", "ProcessingTime"
    )
    values = [StructField(c, windows.schema["value"].dataType) for c in ("first_value", "last_value")]
    found = packs.opened(found, "windows", StructType([*_schema(windows, *WINDOW), *values]))
    return usage_documents(found, subtract(F.col("last_value"), F.col("first_value")))


class _FirstSeen(StatefulProcessor):
    """The first reading of a key, and the first one after each life of the state."""

    def __init__(self, life_ms: int):
        self.life_ms = life_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.since = handle, handle.getValueState("since", "created bigint")

    def handleInputRows(self, key, rows, timerValues) -> Rows:
        now, since = timerValues.getCurrentProcessingTimeInMs(), self.since.get()
        # The timer may come late; the life itself decides.
        if since is None or now - since[0] >= self.life_ms:
            self.since.update((now,))
            self.handle.registerTimer(now + self.life_ms)
            yield min(rows, key=lambda r: r["arrival"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Rows:
        since = self.since.get()
        if since is not None and since[0] + self.life_ms <= expiredTimerInfo.getExpiryTimeInMs():
            self.since.clear()
        return iter(())


def _earliest(frames: Frames) -> Frames:
    for rows in frames:
        yield rows.sort_values("arrival").drop_duplicates("meter_key")


def first_seen_stream(readings: DataFrame, registry: DataFrame | None = None, life_ms: int = FIRST_SEEN_LIFE_MS) -> DataFrame:
    """The first reading of each meter, whole; again ``life_ms`` after that, and not before.

    The life counts from the reading that was let through and is never renewed.  Of a micro-batch's readings
    the first to arrive is taken.  Registered meters, nearly all in a running system, are left out before
    anything is shuffled.
    """
    rows = with_seconds(readings)
    if registry is not None:
        rows = unregistered(rows, registry).select(rows.columns)
    earliest = rows.mapInPandas(_earliest, rows.schema)
    return earliest.groupBy("meter_key").transformWithState(_FirstSeen(life_ms), rows.schema, "Append", "ProcessingTime")


class _InOrder(StatefulProcessor):
    """Readings no older than the newest of their feed before them."""

    def __init__(self, life_ms: int):
        self.life_ms = life_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "t bigint", self.life_ms)

    def handleInputRows(self, key, rows, timerValues) -> Rows:
        known = self.newest.get()
        newest = None if known is None else known[0]
        for r in sorted(rows, key=lambda r: r["arrival"]):
            if newest is None or r["t"] >= newest:
                newest = r["t"]
                yield r
        self.newest.update((newest,))


def _not_passed(frames: Frames) -> Frames:
    """Without readings that an earlier one of the same batch of rows has passed."""
    for rows in frames:
        rows = rows.sort_values("arrival", kind="stable")
        yield rows[rows["t"] >= rows.groupby("feed_id")["t"].cummax()]


def drop_out_of_order_stream(readings: DataFrame, life_ms: int = NEWEST_LIFE_MS) -> DataFrame:
    """Drops readings older than the newest of their feed that arrived before; equal times pass.

    A feed's newest time lives for ``life_ms`` from its last reading.  Micro-batches must come in the order of
    arrival; within one, readings may lie in any order.  A feed's readings of one micro-batch meet in one task:
    what the source admits to a micro-batch bounds them.
    """
    rows = with_seconds(readings)
    kept = rows.mapInPandas(_not_passed, rows.schema)
    return kept.groupBy("feed_id").transformWithState(_InOrder(life_ms), rows.schema, "Append", "ProcessingTime")


class _FormulaAsOf(StatefulProcessor):
    """The formula that each reading of an input, or of many inputs, found when it arrived.

    Inputs lie in parts, which are read when a reading or change falls into them and written when a change does:
    their current formulas for good, and superseded ones, each with the time that happened.
    """

    def __init__(self, formula: StructType, names: list[str], life_ms: int):
        self.formula, self.names, self.life_ms = formula, names, life_ms
        self.found = Row(*names, "val_feed_id", "ops", "has_formula")

    def init(self, handle: StatefulProcessorHandle) -> None:
        part, formulas = "part int", "formulas binary"
        self.current = handle.getMapState("current", part, formulas)
        self.superseded = handle.getMapState("superseded", part, formulas, self.life_ms)

    def known(self, parts: Iterable[int], changes: pa.Table | None, now: int) -> pa.Table | None:
        """All formulas of these parts that still serve, in the order of inputs and versions; changes are kept."""
        tables = []
        # Of equal versions the current one counts, then a change.
        for rank, held in ((0, self.superseded), (2, self.current)):
            for part in parts:
                value = held.getValue((part,))
                if value is not None:
                    rows = packs.unpack(value[0])
                    tables.append(rows.append_column("rank", pa.array(np.full(rows.num_rows, rank))))
        if changes is not None:
            own = {"since": np.full(changes.num_rows, now), "rank": np.full(changes.num_rows, 1)}
            tables.append(pa.table({c: changes[c] for c in _FORMULA} | own))
        if not tables:
            return None
        rows = pa.concat_tables(tables)
        rank, since = rows["rank"].to_numpy(), rows["since"].to_numpy()
        rows = rows.filter(pa.array((rank > 0) | (now - since < self.life_ms))).combine_chunks()
        keys = {"part": rows["part"].to_numpy(), "input": packs.codes(rows["input_id"]), "version": packs.codes(rows["version"])}
        order = packs.sort_order({"part": keys["part"], "input": keys["input"], "version": rows["version"], "rank": rows["rank"]})
        ends = np.append(packs.run_starts(*(k[order] for k in keys.values()))[1:], len(order))[: len(order)] - 1
        order = order[ends]
        rows, part, code = rows.take(order), keys["part"][order], keys["input"][order]
        # Current ones stay as long as they are; from the change that replaces them on they are superseded.
        newest = np.append(code[1:] != code[:-1], True)[: len(code)] | np.append(part[1:] != part[:-1], True)[: len(part)]
        since = np.where(rows["rank"].to_numpy() == 2, now, rows["since"].to_numpy())
        rows = rows.drop_columns(["rank"]).set_column(rows.column_names.index("since"), "since", pa.array(since))
        if changes is not None:
            changed = np.unique(changes["part"].to_numpy())
            for held, kept in ((self.current, newest), (self.superseded, ~newest)):
                mine = rows.filter(pa.array(kept))
                at = mine["part"].to_numpy()
                for p, a, b in zip(changed, np.searchsorted(at, changed), np.searchsorted(at, changed, "right"), strict=True):
                    if a < b:
                        held.updateValue((int(p),), (packs.pack(mine.slice(a, b - a)),))
        return rows

    def as_of(self, readings: pa.Table, formulas: pa.Table | None) -> pa.Table:
        """Adds to readings the newest version of their input that is no later than they are."""
        n, m = readings.num_rows, formulas.num_rows if formulas is not None else 0
        at = np.full(n, -1)
        if n and m:
            inputs = pa.concat_arrays([t["input_id"].combine_chunks() for t in (formulas, readings)])
            arrivals = pa.concat_arrays([formulas["version"].combine_chunks(), readings["arrival"].combine_chunks()])
            code, is_reading = packs.codes(inputs), np.arange(m + n) >= m
            # A change and a reading at the same arrival: the change counts first.
            order = packs.sort_order({"input": code, "arrival": arrivals, "reading": is_reading.astype("int8")})
            last = np.maximum.accumulate(np.where(is_reading[order], -1, np.arange(m + n)))
            met = np.where(last >= 0, order[last], -1)
            met = np.where((met >= 0) & (code[met] == code[order]), met, -1)
            read = is_reading[order]
            at[order[read] - m] = met[read]
        none = pa.nulls(n, pa.string())
        taken = pa.array(at, mask=at < 0)
        found = {c: formulas[c].combine_chunks().take(taken) if m else none for c in ("val_feed_id", "ops")}
        return pa.table({c: readings[c] for c in readings.column_names} | found | {"has_formula": pa.array(at >= 0)})

    def handleInputRows(self, key, rows, timerValues) -> Rows:
        readings, changes = [], []
        for r in rows:
            if r["version"] is None:
                readings.append(r)
            else:
                changes.append({"part": 0, "input_id": key[0], **{c: r[c] for c in _FORMULA[2:]}})
        schema = pa.schema([("part", pa.int32()), ("input_id", pa.string()), *((f.name, to_arrow_type(f.dataType)) for f in self.formula)])
        formulas = self.known([0], pa.Table.from_pylist(changes, schema) if changes else None, timerValues.getCurrentProcessingTimeInMs())
        arrivals = pa.array([r["arrival"] for r in readings], schema.field("version").type)
        dated = self.as_of(pa.table({"input_id": pa.array([key[0]] * len(readings), pa.string()), "arrival": arrivals}), formulas)
        for r, f in zip(readings, dated.select(["val_feed_id", "ops", "has_formula"]).to_pylist(), strict=True):
            yield self.found(*(r[c] for c in self.names), *f.values())


class _PackedFormulaAsOf(_FormulaAsOf):
    """The same with readings and changes that come and go in packs."""

    def handleInputRows(self, key, rows, timerValues) -> Rows:
        given = {"readings": [], "changes": []}
        for r in rows:
            for name, tables in given.items():
                if r[name] is not None:
                    tables.append(packs.unpack(r[name]))
        changes = pa.concat_tables(given["changes"]) if given["changes"] else None
        parts = {int(p) for tables in given.values() for t in tables for p in np.unique(t["part"].to_numpy())}
        formulas = self.known(sorted(parts), changes, timerValues.getCurrentProcessingTimeInMs())
        while given["readings"]:
            yield Row(readings=packs.pack(self.as_of(given["readings"].pop(), formulas).select([*self.found])))


def formula_as_of_stream(
    readings: DataFrame,
    formulas: DataFrame,
    life_ms: int = SUPERSEDED_LIFE_MS,
    salts: int = FORMULA_SALTS,
    groups: int = INPUT_GROUPS,
    parts: int = INPUT_PARTS,
) -> DataFrame:
    """Registered readings with the formula current when they arrived, ready for ``apply_formula``.

    Readings and formula changes are one keyed stream.  The state holds an input's current formula for good and
    a superseded one for ``life_ms``, so that a reading which comes after its formula was replaced still finds
    it.  A change and a reading at the same arrival: the change counts first.  State is empty when a job starts
    on a new checkpoint: earlier formulas do not count then.  Inputs are dealt to ``groups`` of ``parts``; a group's
    readings are spread over ``salts`` tasks, each with the group's formulas.
    """
    names, version = readings.columns, readings.schema["arrival"].dataType
    if clash := {"part", "_group", "_salt"} & {*names}:
        raise ValueError(f"readings have columns {sorted(clash)}")
    place = F.pmod(F.xxhash64("input_id"), F.lit(groups * parts))
    group, part = F.floor(place / parts).cast("int").alias("_group"), (place % parts).cast("int").alias("part")
    spread = F.pmod(F.xxhash64("arrival", "meter_key"), F.lit(salts)).cast("int").alias("_salt")
    rows = packs.packed_by(readings.select(group, spread, part, *names), ["_group", "_salt"], "readings")
    changes = compile_formulas(formulas).select(
        group, part, "input_id", F.col("version").cast(version).alias("version"), F.col("feed_id").alias("val_feed_id"), F.to_json("ops").alias("ops")
    )
    changes = packs.packed_by(changes, ["_group"], "changes")
    # Packed once, not once per salt.
    changes = changes.select("_group", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"), "changes")
    keyed = rows.unionByName(changes, allowMissingColumns=True).groupBy("_group", "_salt")
    formula = StructType([StructField("version", version), *(StructField(c, StringType()) for c in ("val_feed_id", "ops"))])
    out = StructType([*readings.schema, *formula[1:], StructField("has_formula", BooleanType())])
    processor = _PackedFormulaAsOf(formula, names, life_ms)
    found = keyed.transformWithState(processor, StructType([StructField("readings", BinaryType())]), "Append", "ProcessingTime")
    return packs.opened(found, "readings", out).withColumn("ops", F.from_json("ops", OPS))
