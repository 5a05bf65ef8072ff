"""Progress log -> per-form counters, as a batch query and as a keyed stream.

A log line names a ticker and often a form. Outcome lines inherit the last form
of their ticker, and each (ticker, form, date) is counted once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import MapState

from capsieve import rules as R
from capsieve.functions.forms import progress_form
from capsieve.functions.text import blank_to_null, strip
from capsieve.operators.keyed import evaluate_once
from capsieve.session import stored_once

UNSPECIFIED, EIGHT_K = "Unspecified", "8-K Events"


def parse_log(log: DataFrame, message: str = "message") -> DataFrame:
    """Add kind, ticker, form, day, ok and the three 8-K counters to recognised log lines.

    kind: fetch, compute, status, form_status, incomplete, done, start (reset), eight_k.
    """
    text = strip(F.coalesce(F.regexp_extract(message, r"(?s)^[^|]*\|(.*)$", 1), F.lit("")))
    text = F.when(F.col(message).contains("|"), text).otherwise(strip(F.col(message)))
    text = F.regexp_replace(text, r"(?i)^(INFO|WARN|ERROR)\s+", "")
    rows = evaluate_once(log.withColumn("__t", text), "__t").where(F.col("__t").rlike("^(parse_q10|eight_k|dr_forms)"))
    body = F.regexp_extract("__t", r"^(?:parse_q10|dr_forms)\s*\[[^\]]+\]\s*(.*)$", 1)
    rows = rows.withColumn("__b", body)
    b = F.col("__b")
    kind = (
        F.when(F.col("__t").startswith("eight_k:"), "eight_k")
        .when(F.col("__t").startswith("parse_q10: start"), "start")
        .when(F.col("__t").startswith("parse_q10:"), None)
        .when(b.contains(" fetching "), "fetch").when(b.startswith("compute_runway:"), "compute")
        .when(b.contains(" runway status "), "status").when(b.contains(" form status "), "form_status")
        .when(b.contains(" incomplete:"), "incomplete").when(b.rlike(r"\brunway\b.*\bqtrs\b"), "done"))
    rows = evaluate_once(rows.withColumn("kind", kind), "kind").where("kind IS NOT NULL")
    k = F.col("kind")
    first = F.when(k == "compute", F.regexp_extract(b, r"^compute_runway:\s*(\S+)", 1)).otherwise(F.regexp_extract(b, r"^(\S+)", 1))
    raw = (
        F.when(k == "fetch", F.regexp_extract(b, r"^\S+\s+fetching\s+(.+?)(?=\s+(?:filed|url)\b|$)", 1))
        .when(k == "compute", F.regexp_extract(b, r"form=(\S+)", 1))
        .when(k == "form_status", F.regexp_extract(b, r"^\S+\s+(.+?)\s+form status", 1))
        .when(k == "incomplete", F.regexp_extract(b, r"^\S+\s+(.+?)\s+incomplete:", 1)))
    named = progress_form(raw)
    day = F.when(k == "fetch", F.regexp_extract(b, r"filed\s+(\d{4}-\d{2}-\d{2})", 1))
    day = day.when(k == "compute", F.regexp_extract(b, r"date=(\d{4}-\d{2}-\d{2})", 1))
    good = k.isin("done", "form_status") | F.lower(strip(F.regexp_extract(b, r" runway status (.*)$", 1))).startswith("ok")

    def counter(pattern: str) -> Column:
        return F.when(k == "eight_k", F.regexp_extract("__t", pattern, 1).try_cast("bigint"))

    rows = rows.withColumns({
        "ticker": F.when(~k.isin("eight_k", "start"), first), "day": day,
        "form": F.when(blank_to_null(raw).isNotNull() & (named != "Unknown"), named),
        "ok": F.when(k.isin("status", "form_status", "incomplete", "done"), good & (k != "incomplete")),
        "processed": counter(r"processed\s+(\d+)/\d+"), "parsed": counter(r"parsed\s+(\d+)"), "failed": counter(r"failed\s+(\d+)"),
        "restart": (k == "start") | ((k == "eight_k") & F.col("__t").rlike(r"^eight_k:\s*start"))})
    return rows.where((F.col("ticker") != "") | k.isin("eight_k", "start")).drop("__t", "__b")


def carry_state(rows: DataFrame, order: Sequence[str], bin_column: str) -> DataFrame:
    """Add the form (``__form``) and the counted key (``__key``) in force at each line of a ticker.

    A line's form is its own or the ticker's last one. Fetch and compute lines
    set the key (form, day); before the first of them the first other line naming
    a form sets it. Both are carried in two levels: windows inside a time bin, and
    one summary row per (ticker, bin) across bins, so a ticker with a large share
    of the log is spread over its bins.
    """
    place = F.struct(*order)
    inside = Window.partitionBy("ticker", bin_column).orderBy(*order)
    sets = F.col("kind").isin("fetch", "compute")
    rows = rows.withColumn("__f", F.last("form", ignorenulls=True).over(inside))
    rows = rows.withColumn("__set", F.when(sets, F.struct(F.col("__f").alias("form"), F.coalesce("day", F.lit("")).alias("day"))))
    rows = rows.withColumn("__k", F.last("__set", ignorenulls=True).over(inside))

    weak = F.col("kind").isin("form_status", "incomplete")
    bins = rows.groupBy("ticker", bin_column).agg(
        F.max_by("__f", place).alias("__lf"), F.max_by("__k", place).alias("__lk"),
        F.min(F.when(weak, F.struct(place.alias("at"), F.col("form").alias("form")))).alias("__w"))
    earlier = Window.partitionBy("ticker").orderBy(bin_column).rowsBetween(Window.unboundedPreceding, -1)
    until = Window.partitionBy("ticker").orderBy(bin_column).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bins = bins.withColumn("__pf", F.last("__lf", ignorenulls=True).over(earlier))
    # a key set by a compute line without a form takes the form in force there
    closed = F.when(F.col("__lk").isNotNull(), F.struct(
        F.coalesce("__lk.form", "__pf", F.lit(UNSPECIFIED)).alias("form"), F.col("__lk.day").alias("day")))
    bins = bins.withColumn("__lk", closed).withColumn("__pk", F.last("__lk", ignorenulls=True).over(earlier))
    bins = bins.withColumn("__w", F.min("__w").over(until)).select("ticker", bin_column, "__pf", "__pk", "__w")

    out = rows.join(bins, ["ticker", bin_column])
    form = F.coalesce("__f", "__pf", F.lit(UNSPECIFIED))
    here = F.when(F.col("__k").isNotNull(), F.struct(
        F.coalesce("__k.form", "__pf", F.lit(UNSPECIFIED)).alias("form"), F.col("__k.day").alias("day")))
    set_before = F.when(F.col("__w.at") <= place, F.col("__w.form"))
    weakest = F.struct(F.coalesce(set_before, form).alias("form"), F.lit("").alias("day"))
    return out.withColumns({"__form": form, "__key": F.coalesce(here, F.col("__pk"), weakest)}).drop("__f", "__set", "__k", "__pf", "__pk", "__w")


def _after_last(rows: DataFrame, restarts: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows after the last restart line; all rows when there is none."""
    start = restarts.agg(F.max(F.struct(*order)).alias("s")).select("s").scalar()
    return rows.where(F.coalesce(F.struct(*order) > start, F.lit(True)))


def progress(log: DataFrame, ts: str = "ts", ordinal: str = "ord", bin_seconds: int = 3600) -> DataFrame:
    """``(form, parsed, valid, missing, note)`` after the last restart of the log."""
    order = [ts, ordinal]
    parsed = parse_log(log).withColumn("__bin", F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(bin_seconds * 1_000_000)))
    columns = ("kind", "ticker", "form", "day", "ok", "processed", "parsed", "failed", "restart", "__bin", *order)
    parsed = stored_once(parsed.select(*columns), "progress-lines")  # the log is read and parsed once
    rows = _after_last(parsed.where("kind NOT IN ('eight_k', 'start')"), parsed.where("kind = 'start'"), order)

    rows = carry_state(rows, order, "__bin")
    place = F.struct(*order)

    # each key counts once: its first outcome, and its first compute unless an outcome came before
    is_outcome, is_compute = F.col("ok").isNotNull(), F.col("kind") == "compute"
    per_key = rows.groupBy("ticker", "__key").agg(
        F.min(F.when(is_outcome, place)).alias("__o"), F.min_by(F.struct("__form", "ok"), F.when(is_outcome, place)).alias("__out"),
        F.min(F.when(is_compute, place)).alias("__c"), F.min_by("__form", F.when(is_compute, place)).alias("__cform"))
    counted_compute = F.col("__c").isNotNull() & (F.col("__o").isNull() | (F.col("__c") < F.col("__o")))
    steps = per_key.select(F.inline(F.array_compact(F.array(
        F.when(F.col("__o").isNotNull(), F.struct(
            F.col("__out.__form").alias("form"), F.col("__o").alias("at"), F.lit(1).alias("delta"), F.col("__out.ok").alias("ok"))),
        F.when(counted_compute, F.struct(
            F.col("__cform").alias("form"), F.col("__c").alias("at"), F.lit(-1).alias("delta"), F.lit(None).cast("boolean").alias("ok")))))))
    counts = step_totals(steps.withColumn("ts", F.col(f"at.{ts}").cast("timestamp")))

    zero = F.lit(0).cast("bigint")
    named = _after_last(parsed.where("form IS NOT NULL"), parsed.where("kind = 'start'"), order)
    touched = named.select("form").distinct().unionByName(
        per_key.where(F.col("__key.form") == UNSPECIFIED).select(F.col("__key.form").alias("form")).distinct())
    touched = touched.select("form", zero.alias("parsed"), zero.alias("valid"), zero.alias("missing"))
    labels = F.explode(F.array(*[F.lit(p) for p in R.PROGRESS_PLACEHOLDERS]))
    holders = log.sparkSession.range(1).select(
        labels.alias("form"), F.lit("NI").alias("note"), zero.alias("parsed"), zero.alias("valid"), zero.alias("missing"))
    note = F.when(F.col("form") == UNSPECIFIED, "Missing form detail").otherwise("")
    every = counts.unionByName(touched).withColumn("note", note).unionByName(holders).unionByName(eight_k_counts(parsed, order))
    return every.groupBy("form").agg(
        F.max("parsed").alias("parsed"), F.max("valid").alias("valid"), F.max("missing").alias("missing"), F.min("note").alias("note"))


def step_totals(steps: DataFrame, bin_seconds: int = 60) -> DataFrame:
    """``(form, parsed, valid, missing)`` of steps: ``form``, ``ts``, ``at`` (its place), ``delta`` (1 outcome, -1 compute), ``ok``.

    ``parsed`` is the number of computes, raised where outcomes got ahead of it: computes + highest running
    (outcomes - computes). The running sum has two levels: steps of a (form, minute), and minutes of a form.
    """
    steps = steps.withColumn("__bin", F.floor(F.unix_micros("ts") / F.lit(bin_seconds * 1_000_000)))
    running = Window.partitionBy("form", "__bin").orderBy("at")
    bins = steps.withColumn("__run", F.sum("delta").over(running)).groupBy("form", "__bin").agg(
        F.sum("delta").alias("__sum"), F.max("__run").alias("__peak"), F.count_if("ok").alias("valid"),
        F.count_if(~F.col("ok")).alias("missing"), F.count_if(F.col("delta") == -1).alias("computes"))
    before = Window.partitionBy("form").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("__peak", F.col("__peak") + F.coalesce(F.sum("__sum").over(before), F.lit(0)))
    return bins.groupBy("form").agg(
        (F.sum("computes") + F.greatest(F.lit(0), F.max("__peak"))).alias("parsed"),
        F.sum("valid").alias("valid"), F.sum("missing").alias("missing"))


def eight_k_counts(parsed: DataFrame, order: Sequence[str]) -> DataFrame:
    """Row of the latest 8-K counters, none while all are zero."""
    lines = parsed.where("kind IN ('eight_k', 'start')")
    lines = _after_last(lines, lines.where("restart"), order)
    last = [F.coalesce(F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))), F.lit(0)).alias(c) for c in ("processed", "parsed", "failed")]
    row = lines.agg(*last)
    return row.where("processed + parsed + failed > 0").select(
        F.lit(EIGHT_K).alias("form"), F.greatest("processed", F.col("parsed") + F.col("failed")).alias("parsed"),
        F.col("parsed").alias("valid"), F.col("failed").alias("missing"), F.lit("").alias("note"))


# ---------------------------------------------------------------- stream

STEPS = "ticker string, form string, ts timestamp, ord bigint, delta int, ok boolean"
_LAST, _MARK = "form string, key_form string, key_day string", "mark string"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Tracker(StatefulProcessor):
    """State of a ticker: its last form and key, and the keys counted already, each an entry of its own.

    A micro-batch reads and writes the entries of its own keys only. Lines are handled as columns, not one by one.
    """

    def __init__(self, keep_ms: int | None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", _LAST, self.keep_ms)
        self.done, self.computed = (handle.getMapState(n, _MARK, "at long", self.keep_ms) for n in ("done", "computed"))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers: object) -> Iterator[pd.DataFrame]:  # noqa: N802
        lines = pd.concat(list(rows)).sort_values(["ts", "ord"], ignore_index=True)
        form, key_form, key_day = self.last.get() if self.last.exists() else (None, None, None)
        forms = lines["form"].where(lines["form"].notna(), None)
        forms.iloc[0] = forms.iloc[0] if forms.iloc[0] is not None else form
        forms = forms.ffill()
        label = forms.where(forms.notna(), UNSPECIFIED)

        # fetch and compute lines set the key; before any of them the first other line naming a form does
        sets, weak = lines["kind"].isin(("fetch", "compute")), lines["kind"].isin(("form_status", "incomplete"))
        first = (sets | weak).idxmax() if key_form is None and (sets | weak).any() else None
        at = sets.copy()
        if first is not None:
            at.iloc[first] = True
        keys = pd.DataFrame({"form": label.where(at, None), "day": lines["day"].fillna("").where(sets, "").where(at, None)})
        if key_form is not None and not at.iloc[0]:
            keys.iloc[0] = [key_form, key_day or ""]
        keys = keys.ffill()
        mark = keys["form"].where(keys["form"].notna(), label) + "\t" + keys["day"].fillna("")

        def firsts(which: pd.Series, seen: MapState) -> pd.Series:
            """Places of the first such line of each key, -1 where it was counted in an earlier batch."""
            places = pd.Series(lines.index, lines.index)[which].groupby(mark[which]).min()
            known = [m for m in places.index if seen.containsKey((m,))]
            for m in places.index.difference(known):
                seen.updateValue((m,), (int(lines["ord"].iloc[places[m]]),))
            places[known] = -1
            return places

        computed = firsts(lines["kind"] == "compute", self.computed)
        counted_before = {m for m in computed.index if self.done.containsKey((m,))}
        done = firsts(lines["ok"].notna(), self.done)
        self.last.update((*(None if pd.isna(x) else x for x in (forms.iloc[-1], keys["form"].iloc[-1], keys["day"].iloc[-1])),))

        steps = [(i, 1, bool(lines["ok"].iloc[i])) for i in done[done >= 0]]
        # a compute line waits for its outcome, unless that came before
        steps += [(i, -1, None) for m, i in computed[computed >= 0].items() if m not in counted_before and not 0 <= done.get(m, -1) < i]
        if steps:
            steps.sort()
            place = [i for i, *_ in steps]
            yield pd.DataFrame({
                "ticker": key[0], "form": label.iloc[place].to_numpy(), "ts": lines["ts"].iloc[place].to_numpy(), "ord": lines["ord"].iloc[place].to_numpy(),
                "delta": [d for _, d, _ in steps], "ok": pd.array([ok for *_, ok in steps], "boolean")})

    def close(self) -> None:
        pass


def progress_changes(log_stream: DataFrame, ts: str = "ts", ordinal: str = "ord", keep_days: int | None = None) -> DataFrame:
    """Stream of counted steps, each (ticker, form, date) once; :func:`stream_totals` of the stored steps gives the counters.

    State per ticker: last form and key, and the keys already counted, one entry each (in RocksDB, which the session is set
    to). Nothing is forgotten, so a ticker that returns after any time is counted as in :func:`progress`. With ``keep_days``
    an entry ends so long (processing time) after it was written; a key that returns later is counted again. The lines of a
    ticker in one micro-batch are sorted together, so bound the batch at the source (``maxFilesPerTrigger``).
    """
    spark = log_stream.sparkSession
    if spark.conf.get(_STORE).rpartition(".")[2] != _ROCKSDB.rpartition(".")[2]:
        spark.conf.set(_STORE, _ROCKSDB)
    lines = parse_log(log_stream).where("kind NOT IN ('eight_k', 'start')").select(
        "ticker", F.col(ts).cast("timestamp").alias("ts"), F.col(ordinal).alias("ord"), "kind", "form", "day", "ok")
    tracker = _Tracker(None if keep_days is None else keep_days * 86_400_000)
    return lines.groupBy("ticker").transformWithStateInPandas(tracker, STEPS, "Append", "None" if keep_days is None else "ProcessingTime")


def stream_totals(steps: DataFrame) -> DataFrame:
    """Counters per form of the stored steps of :func:`progress_changes`."""
    return step_totals(steps.withColumn("at", F.struct("ts", "ord")))
