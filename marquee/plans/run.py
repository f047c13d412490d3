"""The whole batch: raw files to star schema, with a gate after each layer."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marquee.contracts import CLEAN, RAW, STAR_TABLES
from marquee.operators.checks import GateFailure, gate
from marquee.operators.lookup import merge_names
from marquee.plans import enrichment, gold, quality, silver
from marquee.plans.dimensions import manual_countries, manual_languages, region_dimension
from marquee.sources import audit, catalog
from marquee.sources.csv import read_raw
from marquee.sources.tables import publish, published, published_runs, read_table, write_table

Report = list[tuple[str, str, int]]


@dataclass(frozen=True)
class Inputs:
    """Raw CSV paths, the metadata answers (id, payload) and the standard name lists."""

    movies_main: str | Sequence[str]
    movie_extended: str | Sequence[str]
    answers: DataFrame
    country_names: DataFrame
    language_names: DataFrame
    multi_line: bool = True


class Layers:
    """Paths of one run under a root that all executors share."""

    def __init__(self, spark: SparkSession, root: str, run: str):
        self.spark, self.root, self.run = spark, root, run

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{self.run}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return read_table(self.spark, self.path(layer, name))

    def store(self, layer: str, name: str, df: DataFrame, **options) -> DataFrame:
        write_table(df, self.path(layer, name), **options)
        return self.read(layer, name)

    def store_all(self, layer: str, frames: Mapping[str, Callable[[], DataFrame]], **options: Mapping[str, object]) -> dict[str, DataFrame]:
        """Store tables that do not need each other, side by side, so that the last tasks of one leave no cores
        idle. `options` hold a value per table; the first table that fails, in the given order, fails the layer."""
        def one(name: str) -> DataFrame:
            return self.store(layer, name, frames[name](), **{k: v[name] for k, v in options.items()})
        with ThreadPoolExecutor(max_workers=len(frames)) as pool:
            return dict(zip(frames, pool.map(one, frames), strict=True))


def run_bronze(spark: SparkSession, inputs: Inputs, layers: Layers) -> Report:
    def source(name: str) -> DataFrame:
        return read_raw(spark, getattr(inputs, name), RAW[name], multi_line=inputs.multi_line)

    stored = layers.store_all("bronze", {name: lambda name=name: source(name) for name in RAW}, table=RAW)
    checks = quality.bronze_checks(spark, stored, {name: source(name) for name in RAW})
    return gate("bronze", checks)


def run_silver(spark: SparkSession, inputs: Inputs, layers: Layers) -> Report:
    main, extended = layers.read("bronze", "movies_main"), layers.read("bronze", "movie_extended")
    asked = enrichment.candidates(main, extended)
    # An empty table is stored and left to the gate, which reports it with everything else.
    enriched = layers.store(
        "silver", "movies_enriched", enrichment.movies_enriched(inputs.answers, asked),
        table=CLEAN["movies_enriched"], allow_empty=True,
    )
    unique = silver.unique_enriched(enriched)
    # Stored once, so that four tables do not repeat the join.
    attached = layers.store("work", "attached", silver.attach_enrichment(extended, unique), allow_empty=True)
    countries = merge_names(
        inputs.country_names, manual_countries(spark), "iso_country_code", "country_name"
    )
    languages = merge_names(
        inputs.language_names, manual_languages(spark), "iso_language_code", "language_name"
    )
    layers.store_all("silver", {
        "movies": lambda: silver.movies(main, unique),
        "movie_genres": lambda: silver.movie_genres(attached),
        "production_companies": lambda: silver.production_companies(attached),
        "producing_countries": lambda: silver.producing_countries(attached, countries, region_dimension(spark)),
        "spoken_languages": lambda: silver.spoken_languages(attached, languages),
    }, table=CLEAN)
    return gate("silver", quality.silver_checks(spark, {name: layers.read("silver", name) for name in CLEAN}))


def gold_views(layers: Layers) -> dict[str, DataFrame]:
    """Staging and intermediate frames; nothing is stored."""
    scope = gold.stg_movies(layers.read("silver", "movies"))
    return {
        "stg_movies": scope,
        "stg_movie_genres": gold.stg_movie_genres(layers.read("silver", "movie_genres"), scope),
        "stg_movie_companies": gold.stg_movie_companies(layers.read("silver", "production_companies"), scope),
        "stg_movie_countries": gold.stg_movie_countries(layers.read("silver", "producing_countries"), scope),
        "stg_movie_languages": gold.stg_movie_languages(layers.read("silver", "spoken_languages"), scope),
        "int_yearly_movie_trends": gold.yearly_movie_trends(scope),
        "int_movie_financials": gold.movie_financials(scope),
    }


def run_gold(spark: SparkSession, layers: Layers) -> Report:
    views = gold_views(layers)
    empty = dict.fromkeys((*views, *STAR_TABLES), True)
    attributes = ("genres", "companies", "countries", "languages")
    stored = layers.store_all(
        "gold", {f"bridge_movie_{a}": lambda a=a: gold.bridge(views[f"stg_movie_{a}"]) for a in attributes}, allow_empty=empty)
    # A stored bridge holds the rows of its staging frame, so later readers use it instead.
    views.update({f"stg_movie_{a}": stored[f"bridge_movie_{a}"] for a in attributes})
    # Views whose checks would run them several times are stored with the run's work tables.
    inner = {name: views[name] for name in ("int_yearly_movie_trends", "int_movie_financials")}
    views.update(layers.store_all("work", {name: lambda df=df: df for name, df in inner.items()}, allow_empty=empty))
    stored.update(layers.store_all("gold", {
        "fact_movies": lambda: gold.fact_movies(
            views["stg_movies"], views["stg_movie_genres"], views["stg_movie_companies"],
            views["stg_movie_countries"], views["stg_movie_languages"],
        ),
        "mart_genre_share": lambda: gold.mart_genre_share(views["stg_movie_genres"]),
        "mart_language_share": lambda: gold.mart_language_share(views["stg_movie_languages"]),
        "mart_country_summary": lambda: gold.mart_country_summary(views["stg_movie_countries"]),
        "mart_yearly_trends": lambda: gold.mart_yearly_trends(views["int_yearly_movie_trends"]),
    }, allow_empty=empty))
    return gate("gold", quality.gold_checks(spark, {**views, **stored}))


def run(spark: SparkSession, inputs: Inputs, root: str, run_name: str) -> dict[str, Report]:
    """Run every layer; readers see the result only after the last gate has passed. The name of a run
    that was published is refused, so nothing that readers see is ever written to; the name of a run
    that failed may be used again. Every gate's report goes to the history of checks (`_audit`)."""
    if run_name in published_runs(spark, root):
        raise ValueError(f"run {run_name!r} is published; choose another name")
    layers = Layers(spark, root, run_name)
    steps = {
        "bronze": lambda: run_bronze(spark, inputs, layers),
        "silver": lambda: run_silver(spark, inputs, layers),
        "gold": lambda: run_gold(spark, layers),
    }
    reports = {}
    for layer, step in steps.items():
        try:
            reports[layer] = step()
        except GateFailure as stop:
            audit.record(spark, root, run_name, layer, stop.rows, stopped=True)
            raise
        audit.record(spark, root, run_name, layer, reports[layer], stopped=False)
    publish(spark, root, run_name)
    return reports


def publish_to_catalog(spark: SparkSession, root: str, database: str) -> None:
    """Let the catalogue show the published run: clean and star tables, and the staging views over them. Called
    again after a later publication, it moves the tables; views stay as they are and read the new run."""
    layers = Layers(spark, root, published(spark, root))
    catalog.create_database(spark, database)
    for layer, names in (("silver", CLEAN), ("gold", STAR_TABLES)):
        for name in names:
            catalog.point(spark, database, name, layers.path(layer, name))
    catalog.define_staging(spark, database)


def register_views(spark: SparkSession, root: str, run_name: str | None = None) -> None:
    """Temporary views over a run, the published one by default, under the names of its tables."""
    run_name = run_name or published(spark, root)
    layers = Layers(spark, root, run_name)
    for name, df in {**gold_views(layers), **star(spark, root, run_name)}.items():
        df.createOrReplaceTempView(name)


def star(spark: SparkSession, root: str, run_name: str | None = None) -> dict[str, DataFrame]:
    """The nine tables of a run, the published one by default."""
    layers = Layers(spark, root, run_name or published(spark, root))
    return {name: layers.read("gold", name) for name in STAR_TABLES}
