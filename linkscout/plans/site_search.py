"""The whole qualification run: search, clearance, rank attributes, link budget, ranking."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscout.operators import classify, enrich, outputs, parameters, rank, ranker, search
from linkscout.operators.storage import materialise, observed, run_folder
from linkscout.sources import sinks


@dataclass(frozen=True)
class Tables:
    """Input tables of a run. ``sources`` carries the parameters of each search site."""

    sources: DataFrame
    buildings: DataFrame
    asd: DataFrame
    mgt: DataFrame
    sites: DataFrame
    scrub: DataFrame
    lit: DataFrame
    licences: DataFrame
    rankings: DataFrame
    replies: DataFrame
    clearance: DataFrame


def find_candidates(t: Tables) -> DataFrame:
    """Initial search, numbered in search order."""
    return search.with_sequence(
        search.initial_search(t.sources, t.buildings, t.asd, t.mgt, t.sites, t.scrub)
    )


def clear_paths(t: Tables, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Clearance per candidate where the site asks for it; hopeless candidates go."""
    asked = candidates.join(t.sources.select("site_id", "check_clearance"), "site_id")
    scored = enrich.with_clearance(asked, t.clearance, keys, F.col("check_clearance"))
    return enrich.drop_blocked(scored)


def rank_tables(t: Tables, candidates: DataFrame) -> dict[str, DataFrame]:
    return rank.rank_candidates(
        candidates, t.buildings, t.lit, t.licences, t.asd, t.mgt, t.sites, t.scrub, t.rankings
    )


@dataclass(frozen=True)
class Result:
    """Tables of a finished run, all lazy but the candidates and the assembled table they come from."""

    candidates: DataFrame
    ranks: dict[str, DataFrame]
    assembled: DataFrame
    ranked: DataFrame

    @property
    def all_ranked(self) -> DataFrame:
        return ranker.join_back(self.assembled, self.ranked)


def qualify(t: Tables, candidates: DataFrame, reply_keys: list[str]) -> Result:
    """Rank attributes, link budget and ranking for all search sites at once, from their (cleared) candidates.

    The candidate set and the assembled set are read by several later steps, so each is written once.
    """
    candidates = materialise(candidates)
    ranks = rank_tables(t, candidates)
    assembled = enrich.join_link_budget(enrich.assemble(candidates, ranks), t.replies, reply_keys)
    assembled = materialise(enrich.linked(assembled))
    return Result(candidates, ranks, assembled, ranker.rank(assembled, F.col("check_clearance")))


def run_to_files(t: Tables, candidates: Callable[[], DataFrame], reply_keys: list[str], path: str) -> None:
    """One whole run and all its files, published together below ``path``: see :func:`sinks.current`.

    Intermediates are written once for all files and deleted after. ``candidates`` gives the (cleared) candidates; it is
    called inside the run, so that what it writes is deleted as well. Rows of the files and empty columns of the report are
    observed while tables are written, so no pass is made to count them.
    """
    spark = t.sources.sparkSession
    with run_folder(spark), sinks.published(spark, path) as run:
        result = qualify(t, candidates(), reply_keys)
        ranked, filled = observed(result.ranked, outputs.filled(result.ranked))
        placed = materialise(result.all_ranked)
        towers = ranked.where(F.col("candidate_type") == "cci_sites").select("id")
        short = ranked.select(*outputs.candidate_file(ranked).columns, "speed")
        planner = parameters.planner_rows(parameters.search_parameters(t.sources)).withColumn("site", F.col("Site Name"))

        def csv(table: str, df: DataFrame, *partition_by: str) -> None:
            sinks.write_csv(run.watched(table, df), run.folder(table), *partition_by)

        def parquet(table: str, df: DataFrame) -> None:
            run.watched(table, df).write.parquet(run.folder(table))

        csv("candidates", sinks.candidate_order(placed))
        parquet("report", outputs.sorted_report(ranked, filled))
        for kind, rows in result.ranks.items():
            parquet(f"sheets/candidate_type={kind}", ranker.rank_sheet(rows, kind, placed))
        parquet("layers/candidates", outputs.candidate_points(ranked))
        parquet("layers/spider_lines", outputs.spider_lines(ranked, t.sources))
        csv("ranked", short, "candidate_type")
        csv("tower_scrub", classify.scrub_sheet(t.scrub, towers))
        csv("planner", planner, "site")
