"""The session catalogue as a sink: declared tables with descriptions, and views that follow publications.

Policy: the raw, clean and star layers are tables, staging is views. A stored layer appears in the catalogue as
an external table; a publication points it to the files of the published run. Views are defined once, by name
over these tables, so they read the new run without being defined again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, types as T

from marquee.contracts import Column, Table
from marquee.functions.dates import SCOPE_FROM, SCOPE_TO
from marquee.sources.tables import create_declared, write_table
from marquee.sources.versions import current


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def store_declared(df: DataFrame, database: str, table: Table, allow_empty: bool = False) -> DataFrame:
    """Make the rows the content of the declared table, and return the table.

    The rows become a new version in the database's folder, cast to the declaration; a value that does not
    fit, or an empty result, fails the job and leaves the table as it was. Then the table is pointed to the
    new version: created with its descriptions if it is absent, dropped and created anew if it exists in
    another layout.
    """
    spark = df.sparkSession
    path = f"{spark.catalog.getDatabase(database).locationUri}/{table.name}-versions"
    write_table(df, path, table, allow_empty)
    point(spark, database, table.name, path, table)
    return spark.table(f"`{database}`.`{table.name}`")


def descriptions(spark: SparkSession, database: str, table: str) -> DataFrame:
    """position, column_name, data_type, description as the catalogue has them."""
    fields = spark.table(f"`{database}`.`{table}`").schema.fields
    rows = [(i, f.name, f.dataType.simpleString(), f.metadata.get("comment")) for i, f in enumerate(fields, 1)]
    return spark.createDataFrame(rows, "position bigint, column_name string, data_type string, description string")


def point(spark: SparkSession, database: str, name: str, path: str, table: Table | None = None) -> None:
    """Let a catalogue table show the current version of the stored table at `path`. The table is an external
    one, so dropping it leaves the files."""
    version = current(spark, path)
    if version is None or len(version.parts) != 1:
        raise ValueError(f"{path} has no version of one part")
    part, full = version.parts[0], f"`{database}`.`{name}`"
    declared = table or Table(name, tuple(Column(f.name, f.dataType) for f in part.schema.fields))
    target = f"{path}/{part.folder}"
    if spark.catalog.tableExists(full) and _layout(spark.table(full).schema) == _layout(declared.schema):
        spark.sql(f"ALTER TABLE {full} SET LOCATION '{target}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        create_declared(spark, full, declared, target)
    spark.catalog.refreshTable(full)


def _layout(schema: T.StructType) -> list[tuple[str, str, str]]:
    return [(f.name, f.dataType.simpleString(), f.metadata.get("comment", "")) for f in schema.fields]


#: Staging views by name: the clean tables they read, and their rows.
STAGING = {
    "stg_movies": """
        SELECT movie_id, movie_title, release_date, year(release_date) AS release_year, budget, revenue
        FROM {db}.movies WHERE release_date >= DATE'{start}' AND release_date < DATE'{end}'""",
    "stg_movie_genres": """
        SELECT DISTINCT movie_id, genre FROM {db}.movie_genres
        WHERE EXISTS (SELECT 1 FROM {db}.stg_movies s WHERE s.movie_id = movie_genres.movie_id)""",
    "stg_movie_companies": """
        SELECT movie_id, company_name FROM {db}.production_companies
        WHERE EXISTS (SELECT 1 FROM {db}.stg_movies s WHERE s.movie_id = production_companies.movie_id)""",
    "stg_movie_countries": """
        SELECT movie_id, iso_country_code, country_name, country_region, country_subregion, is_service_restricted
        FROM {db}.producing_countries
        WHERE EXISTS (SELECT 1 FROM {db}.stg_movies s WHERE s.movie_id = producing_countries.movie_id)""",
    "stg_movie_languages": """
        SELECT movie_id, iso_language_code, language_name FROM {db}.spoken_languages
        WHERE EXISTS (SELECT 1 FROM {db}.stg_movies s WHERE s.movie_id = spoken_languages.movie_id)""",
}


def define_staging(spark: SparkSession, database: str, start=SCOPE_FROM, end=SCOPE_TO, names: Iterable[str] = tuple(STAGING)) -> None:
    """Define the staging views, once; their tables must be in the catalogue."""
    for name in names:
        body = STAGING[name].format(db=f"`{database}`", start=start, end=end)
        spark.sql(f"CREATE VIEW IF NOT EXISTS `{database}`.`{name}` AS {body}")
