"""Weekly, daily and older research flows over stage tables in one folder.

Every stage reads stored tables and writes one, so a later run can start at any
stage. ``start_stage`` names the first stage to run; earlier ones are read back.
All flows take the run date explicitly.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capsieve.operators import events as evt
from capsieve.operators import filings as fil
from capsieve.operators import gates, market, resolution, runway, scoring, watchlist
from capsieve.operators.keyed import align, one_row_each, with_all_parts
from capsieve.rules import RULES, Rules
from capsieve.schemas import TABLES, schema
from capsieve.sources.accumulated import MONTH, accumulate, read_store
from capsieve.sources.tables import (
    append_table, check_columns, first_existing, log_error, log_step, newest, read_table, stage_counts, table_exists, write_table,
)

WEEKLY_STAGES = ("profiles", "filings", "events", "prices", "hydrate", "deep_research", "validated")
DAILY_STAGES = ("prices", "hydrate")
FILINGS_STORE = "02_filings_store"
FILING_KEYS = ("CIK", "URL", "Form", "FiledAt", "Ticker")
LEGACY_STAGES = ("bundle", "runway", "populate", "watchlist")


@dataclass(frozen=True)
class Run:
    """Where a flow reads and writes, its rules and its date."""

    spark: SparkSession
    folder: str
    as_of: dt.date | str
    rules: Rules = RULES

    def read(self, name: str, *required: str) -> DataFrame:
        return read_table(self.spark, self.folder, name, required)

    def write(self, df: DataFrame, name: str) -> None:
        self.logged(name, lambda: write_table(df, self.folder, name, schema(name) if name in TABLES else None))

    def logged(self, name: str, step: Callable[[], int], note: str = "OK") -> int:
        """Runs a step that returns a number of rows and adds its line to the run log; a failure goes to the error log."""
        began, now = time.monotonic(), dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        try:
            rows = step()
        except Exception as error:
            log_error(self.spark, self.folder, name, f"{type(error).__name__}: {str(error)[:500]}", now)
            raise
        log_step(self.spark, self.folder, name, rows, round(1000 * (time.monotonic() - began)), note, now)
        return rows

    def maybe(self, name: str) -> DataFrame | None:
        return self.read(name) if table_exists(self.spark, self.folder, name) else None


def ordered(df: DataFrame, ordinal: str) -> DataFrame:
    """A tie-break that depends on a row's content alone, not on how the table's files are laid out."""
    return df.withColumn(ordinal, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))


def profiles_stage(run: Run, profiles: DataFrame, quotes: DataFrame, ordinal: str = "ord") -> None:
    """01_profiles: complete, gated companies with a usable quote; those with unseen tickers are added to the stored ones."""
    listed = gates.universe_gate(gates.complete_rows(profiles), run.rules)
    quoted = align(gates.quote_gate(market.with_quotes(listed, quotes, ordinal), run.rules), schema("01_profiles"))
    run.logged("01_profiles", lambda: append_table(run.spark, quoted, run.folder, "01_profiles", ("Ticker",), run.as_of, None, "UpdatedAt"), "append+purge")


def filings_stage(run: Run, filings: DataFrame, texts: DataFrame | None = None, ordinal: str = "ord") -> None:
    """02_filings_store, 02_filings and 01_universe_gated.

    Filings of all deliveries accumulate in the store, by month; the runway is read for new ones only. 02_filings are the stored
    filings inside retention of covered companies, with their age; 01_universe_gated are these companies.
    """
    profiles = ordered(run.read("01_profiles", "Ticker", "CIK"), ordinal)
    new = fil.purge(fil.fill_ticker(filings, profiles, ordinal), run.as_of, run.rules)

    def with_runway(rows: DataFrame) -> DataFrame:
        return rows if texts is None else runway.attach_runway(rows, runway.runway_by_url(rows, texts))

    run.logged("filings", lambda: accumulate(new, run.folder, FILINGS_STORE, FILING_KEYS, "FiledAt", schema("02_filings"), with_runway), "append+purge")
    kept = fil.purge(read_store(run.spark, run.folder, FILINGS_STORE, schema("02_filings")).drop(MONTH), run.as_of, run.rules)
    gate = fil.coverage(kept, profiles)
    run.write(fil.with_age(fil.fill_company(fil.keep_eligible(kept, gate), profiles, ordinal), run.as_of), "02_filings")
    run.write(fil.keep_eligible(profiles, gate), "01_universe_gated")


def events_stage(run: Run, texts: DataFrame | None = None, ordinal: str = "ord", match: str = "substring") -> None:
    """09_8k_events and 09_events from the text of the 8-K filings.

    ``texts`` has URL and Text and may have PressReleases and Exhibits. Without
    it a stored older event table is promoted.
    """
    if texts is None:
        stored = first_existing(run.spark, run.folder, ("09_events", "09_8k_events"))
        if stored is not None and not table_exists(run.spark, run.folder, "09_events"):
            run.write(evt.canonical(stored), "09_events")
        return
    filings = evt.select_8k(run.read("02_filings", "URL", "Form"), ordinal).join(texts, "URL")
    run.write(evt.actionable(evt.build_events(evt.parse_8k(filings), match)), "09_8k_events")
    run.write(evt.canonical(run.read("09_8k_events")), "09_events")


def prices_stage(run: Run, prices: DataFrame) -> None:
    """03_prices: new bars appended, old ones out of the window dropped."""
    run.logged("03_prices", lambda: append_table(
        run.spark, prices, run.folder, "03_prices", ("Ticker", "Date"), run.as_of, run.rules.price_keep_days, "Date"), "append+purge")


def hydrate_stage(run: Run, ordinal: str = "ord") -> None:
    """05_hydrated_candidates, 06_shortlist_candidates and 20_candidate_shortlist."""
    latest = market.latest_with_adv(run.read("03_prices", "Ticker", "Close", "Volume", "Date"), rows=run.rules.adv_rows, undated="win")
    universe = run.read("01_universe_gated", "Ticker", "CIK")
    run.write(fil.hydrate(universe, latest, run.read("02_filings"), run.maybe("04_fda"), ordinal), "05_hydrated_candidates")
    hydrated = run.read("05_hydrated_candidates")
    run.write(gates.shortlist_gate(hydrated, run.rules), "06_shortlist_candidates")
    one = [one_row_each(t, scoring.EVIDENCE_CELLS) for t in (hydrated, run.read("06_shortlist_candidates"))]
    events = ordered(run.read("09_events"), ordinal)
    run.write(scoring.candidate_shortlist(universe, events, *one, ordinal, run.rules), "20_candidate_shortlist")


def research_stage(run: Run, texts: DataFrame | None = None, peers: DataFrame | None = None, ordinal: str = "ord") -> None:
    """30_deep_research, of the shortlist that was written last: the canonical one or an older one."""
    shortlist = newest(run.spark, run.folder, "20_candidate_shortlist", "shortlist_candidates")
    if shortlist is None:
        shortlist = run.read("20_candidate_shortlist")
    check_columns(shortlist, "20_candidate_shortlist", ("Ticker", "Company", "CIK"))
    events = ordered(run.read("09_events"), ordinal)
    run.write(scoring.deep_research(shortlist, run.read("02_filings"), events, run.as_of, ordinal, texts, peers), "30_deep_research")


def validated_stage(run: Run) -> None:
    """40_validated_selections and 40_tbd_exclusions."""
    checked = scoring.validate(scoring.complete_research(
        run.read("30_deep_research"), run.read("01_universe_gated"), run.read("20_candidate_shortlist")))
    run.write(scoring.validated_selections(checked), "40_validated_selections")
    run.write(scoring.exclusions(checked), "40_tbd_exclusions")


def _from(stages: tuple[str, ...], start: str) -> tuple[str, ...]:
    if start not in stages:
        raise ValueError(f"unknown stage {start!r}; one of {', '.join(stages)}")
    return stages[stages.index(start):]


def weekly(run: Run, inputs: dict[str, DataFrame], start_stage: str = "profiles") -> DataFrame:
    """Run the weekly flow from a stage on and return the funnel counts.

    Inputs: ``profiles``, ``quotes``, ``filings``, ``prices`` and optionally ``texts`` and
    ``peers``. Only the inputs of the stages that run are needed.
    """
    steps = {
        "profiles": lambda: profiles_stage(run, inputs["profiles"], inputs["quotes"]),
        "filings": lambda: filings_stage(run, inputs["filings"], inputs.get("texts")),
        "events": lambda: events_stage(run, inputs.get("texts")),
        "prices": lambda: prices_stage(run, inputs["prices"]) if "prices" in inputs else None,
        "hydrate": lambda: hydrate_stage(run),
        "deep_research": lambda: research_stage(run, inputs.get("texts"), inputs.get("peers")),
        "validated": lambda: validated_stage(run),
    }
    for stage in _from(WEEKLY_STAGES, start_stage):
        steps[stage]()
    return funnel(run)


def daily(run: Run, prices: DataFrame | None = None, start_stage: str = "prices") -> DataFrame:
    """Refresh prices, re-apply the coverage gate to stored filings, and rebuild the shortlists."""
    stages = _from(DAILY_STAGES, start_stage)
    profiles, filings = run.read("01_profiles", "Ticker"), run.read("02_filings", "Ticker", "Form")
    gate = fil.coverage(filings, profiles)
    run.write(fil.keep_eligible(profiles, gate), "01_universe_gated")
    if "prices" in stages and prices is not None:
        prices_stage(run, prices)
    hydrate_stage(run)
    return funnel(run)


def landed(run: Run) -> resolution.Sources:
    """What has landed of the filings, from the stored tables 02_facts, 02_documents, 02_index_pages and 02_exhibits."""
    return resolution.Sources(*(run.maybe(n) for n in ("02_facts", "02_documents", "02_index_pages", "02_exhibits")))


def legacy(run: Run, results: DataFrame | None = None, start_stage: str = "bundle", ordinal: str = "ord",
           sources: resolution.Sources | None = None) -> DataFrame:
    """The older chain 06 -> 07 -> 08 -> 10 -> 11; returns the watchlist drop counts.

    Runway verdicts come from ``sources``, by default the landed tables of the folder; ``results (URL, result)`` replaces them.
    """
    stages = _from(LEGACY_STAGES, start_stage)
    if "bundle" in stages:
        source = first_existing(run.spark, run.folder, ("06_shortlist_candidates", "05_hydrated_candidates"))
        if source is None:
            source = run.read("06_shortlist_candidates")
        run.write(scoring.research_bundle(source), "07_deep_research_results")
    if "runway" in stages:
        if results is None:
            results = resolution.first_results(run.read("02_filings"), sources or landed(run), ordinal)
        # verdicts are made once per company; cells of all parts are put beside them again
        bundle = run.read("07_deep_research_results")
        found = runway.extract_runway(one_row_each(bundle, scoring.BUNDLE_CELLS), run.read("02_filings"), results, run.as_of, ordinal)
        run.write(with_all_parts(one_row_each(found, ["RunwayNotes"]), "Ticker", (bundle, scoring.BUNDLE_CELLS), (found, ["RunwayNotes"])),
                  "08_runway_extract_results")
    if "populate" in stages:
        research, cells = run.read("08_runway_extract_results"), (*scoring.BUNDLE_CELLS, "RunwayNotes")
        found = scoring.populate_research(one_row_each(research, cells), run.read("02_filings"), run.as_of, run.maybe("04_fda"),
                                          ordinal=ordinal, rules=run.rules)
        own = scoring.CATEGORIES
        run.write(with_all_parts(one_row_each(found, own), "Ticker", (research, cells), (found, own)), "10_dr_populate_results")
    prices = market.latest_with_adv(run.read("03_prices"), rows=run.rules.adv_rows)
    hydrated = one_row_each(run.read("05_hydrated_candidates"), scoring.EVIDENCE_CELLS)
    table = market.market_table(hydrated).withColumn(ordinal, F.lit(0)).unionByName(market.market_table(prices).withColumn(ordinal, F.lit(1)))
    events = ordered(run.read("09_8k_events"), ordinal)
    checked = watchlist.check_research(run.read("10_dr_populate_results"), table, events, run.as_of, run.rules, ordinal)
    run.write(checked, "11_watchlist_checked")
    stored = run.read("11_watchlist_checked")
    run.write(watchlist.watchlist(stored), "11_validated_watchlist")
    return watchlist.drop_counts(stored)


def funnel(run: Run) -> DataFrame:
    """Rows per stage table; absent tables count as 0."""
    names = {"universe": "01_universe_gated", "filings": "02_filings", "events": "09_events", "shortlist": "20_candidate_shortlist",
             "deep_research": "30_deep_research", "validated": "40_validated_selections", "tbd": "40_tbd_exclusions"}
    return stage_counts({label: run.maybe(name) for label, name in names.items()}, run.spark)
