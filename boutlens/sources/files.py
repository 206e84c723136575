"""Readers and writers of results, ledgers, reports, manifests, market observations and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ddl
from .storage import exists, replace_folder

# The shapes of the files.
RESULTS = (
    "event_url string, event_date string, collected_at string, fights array<struct<fight_id: string, fighter_a_name: string,"
    " fighter_b_name: string, winner_name: string, result: string, method_of_victory: string, ending_round: int,"
    " ending_time: string, source_fight_url: string>>"
)
MANIFEST = (
    "run_id string, status string, code_version string, started_at string, finished_at string, errors array<struct<message: string, resolved: boolean>>,"
    " listing struct<url: string, fetched_at: string, event_urls: array<string>, latest_event_date: string>,"
    " event_fights map<string, array<string>>, page_counts map<string, int>, feature_columns array<string>"
)
LEDGER = (
    "kind string, run_id string, cutoff string, fighter_a string, fighter_b string, predicted_winner string,"
    " win_probability double, predicted_method string, predicted_round int, scheduled_rounds int, fight_id string, error string"
)
MARKET = ddl(
    "fighter_a string", "fighter_b string", "event_date date", "line_a int", "line_b int", "share_a double", "share_b double",
    "observed_at timestamp", "source string",
)
METRICS_KEY = "report_sha256"
MANAGED = r"\n\n=== POST-CARD RESULTS \(managed\) ===\n"
BLOCK = r"^([^\n|]+?) vs ([^\n|]+?)(?: \|[^\n]*)?\n(?:Pick:|Prediction failed:)"


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """One row per contest of every result snapshot; malformed files fail the read."""
    df = spark.read.schema(RESULTS).option("mode", "FAILFAST").option("multiLine", "true").json(path)
    return df.select("event_url", F.col("event_date").cast("date").alias("event_date"), F.explode("fights").alias("f")).select("event_url", "event_date", "f.*")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Predictions of complete runs, with ``position`` in their ledger: a file counts if its first line is its only run line
    and its last line says complete. Malformed lines fail the read."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.split("value", r"\r?\n").alias("lines"))
    lines = whole.select("file", F.posexplode(F.filter("lines", lambda x: F.trim(x) != "")).alias("line", "text"))
    df = lines.select("file", "line", F.from_json("text", LEDGER, {"mode": "FAILFAST"}).alias("r")).select("file", "line", "r.*")
    per = df.groupBy("file").agg(
        F.min_by("kind", "line").alias("first"), F.max_by("kind", "line").alias("last"), F.count_if(F.col("kind") == "run").alias("runs"),
        F.min_by(F.struct("run_id", "cutoff"), "line").alias("run"),
    )
    complete = per.filter("first = 'run' AND last = 'complete' AND runs = 1").select("file", "run")
    position = F.row_number().over(Window.partitionBy("file").orderBy("line")) - 1
    rows = df.filter("kind = 'prediction'").withColumn("position", position).drop("run_id", "cutoff", "kind", "line")
    return rows.join(complete, "file").select("run.*", *rows.columns)


def ledger_disagreements(reports: DataFrame, ledger: DataFrame) -> DataFrame:
    """(run_id, position, problem) where a text report and its ledger differ: in a row, a name, an ending, or the confidence.

    Both: run_id, position, fighter_a, fighter_b, predicted_winner, predicted_method, predicted_round, win_probability, error.
    """
    keys, fields = ["run_id", "position"], ("fighter_a", "fighter_b", "predicted_winner", "predicted_method", "predicted_round")
    side = lambda df, name: df.select(*keys, F.struct(*fields, "win_probability", "error").alias(name))
    both = side(reports, "seen").join(side(ledger, "saved"), keys, "full")
    differ = F.when(F.col("seen").isNull() | F.col("saved").isNull(), "count")
    for c in fields:
        differ = differ.when(~F.col(f"seen.{c}").eqNullSafe(F.col(f"saved.{c}")), c)
    gap = F.abs(F.col("seen.win_probability") - F.col("saved.win_probability")) > 0.000500001
    differ = differ.when(F.col("seen.error").isNull() & F.coalesce(gap, F.lit(True)), "confidence")
    return both.select(*keys, differ.alias("problem")).filter("problem IS NOT NULL")


def parse_reports(reports: DataFrame, text: str = "value") -> DataFrame:
    """Prediction rows of text reports, with what is wrong with them.

    A prediction starts with a line 'A vs B', perhaps followed by ' | ...', whose next line is a Pick or a failure. The report's
    cutoff, date, source and time stand before. ``problem``: a forecast without ending or confidence, a pick that is no
    participant, a probability outside 0.5 to 1, a pairing twice, no cutoff. Results written behind the report are not read.
    """
    other = [c for c in reports.columns if c != text]
    body = F.split(F.regexp_replace(text, "\r\n", "\n"), MANAGED)[0]
    head = r"(?:^|\n)(?=[^\n|]+? vs [^\n|]+?(?: \|[^\n]*)?\n(?:Pick:|Prediction failed:))"
    whole = lambda p: F.nullif(F.trim(F.regexp_extract("body", p, 1)), F.lit(""))
    df = reports.select(*other, body.alias("body")).withColumns({
        "cutoff": whole(r"(?m)^Evidence cutoff: strictly before (\d{4}-\d{2}-\d{2})"),
        "event_date": F.coalesce(whole(r"(?m)^Event date: (\d{4}-\d{2}-\d{2})"), whole(r"^[^\n]*\| (\d{4}-\d{2}-\d{2})(?:\n|$)")),
        "source": whole(r"(?m)^Source: (\S+)"), "generated_at": whole(r"(?m)^(?:Generated|Status checked): (.+)$"),
    })
    found = ("cutoff", "event_date", "source", "generated_at")
    long = df.select(*other, *found, F.posexplode(F.filter(F.split("body", head), lambda x: x.rlike(BLOCK))).alias("position", "block"))
    field = lambda p, i=1: F.nullif(F.trim(F.regexp_extract("block", p, i)), F.lit(""))
    ending = r"(?m)^Predicted ending: (.+), round (\d+)$"
    long = long.withColumns({
        "fighter_a": field(BLOCK), "fighter_b": field(BLOCK, 2), "error": field(r"(?m)^Prediction failed: (.+)$"),
        "predicted_winner": field(r"(?m)^Pick: (.+)$"), "win_probability": field(r"(?m)^Confidence: ([\d.]+)%").try_cast("double") / 100,
        "predicted_method": field(ending), "predicted_round": field(ending, 2).try_cast("int"),
        "scheduled_rounds": field(r"Scheduled distance assumes ([35]) rounds").try_cast("int"),
    })
    name = lambda c: F.lower(F.trim(F.col(c)))
    pair = F.array_sort(F.array(name("fighter_a"), name("fighter_b")))
    twice = F.count("*").over(Window.partitionBy(*other, pair)) > 1 if other else F.lit(False)
    made = F.col("error").isNull()
    problem = (
        F.when(F.col("cutoff").isNull(), "no cutoff").when(twice, "pairing twice")
        .when(made & (F.col("predicted_method").isNull() | F.col("win_probability").isNull()), "incomplete forecast")
        .when(made & ~F.coalesce(name("predicted_winner").isin(name("fighter_a"), name("fighter_b")), F.lit(False)), "pick is no participant")
        .when(made & ~F.col("win_probability").between(0.5, 1.0), "probability")
    )
    return long.withColumn("problem", problem).drop("block")


def read_text_reports(spark: SparkSession, path: str) -> DataFrame:
    return parse_reports(spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name()))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document; operators.manifest.from_document makes rows of cards of it."""
    return spark.read.schema(MANIFEST).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def manifest_contests(manifest: DataFrame) -> DataFrame:
    """(run_id, event_url, fight_url) of the cumulative manifest."""
    cards = manifest.select("run_id", F.explode("event_fights").alias("event_url", "urls"))
    return cards.select("run_id", "event_url", F.explode("urls").alias("fight_url"))


def read_market(spark: SparkSession, path: str) -> DataFrame:
    """Observations; a key that the schema lacks, a price within 100 of zero or a share outside 0 to 100 fails the read."""
    raw = spark.read.text(path)
    keys = F.json_object_keys("value")
    names = F.array(*[F.lit(f.name) for f in MARKET.fields])
    checked = raw.withColumn("extra", F.size(F.array_except(keys, names)))
    parsed = checked.select(F.when(F.col("extra") > 0, F.raise_error(F.lit("unknown key in market file"))).otherwise(F.from_json("value", MARKET)).alias("m"))
    sound = F.lit(True)
    for side in "ab":
        price, share = F.col(f"m.line_{side}"), F.col(f"m.share_{side}")
        sound &= F.coalesce(F.abs(price) >= 100, F.lit(True)) & F.coalesce(share.between(0, 100), F.lit(True))
    good = parsed.select(F.when(sound, F.col("m")).otherwise(F.raise_error(F.lit("price or share out of range in market file"))).alias("m"))
    return good.select("m.*")


def source_registry(rows: DataFrame) -> DataFrame:
    """Active sources (source_id, kind, weight 0..10, active); an id that is missing or stands twice, or a weight out of
    range, fails."""
    bad = rows.groupBy("source_id").agg(F.count("*").alias("n"), F.every(F.coalesce(F.col("weight").between(0, 10), F.lit(False))).alias("sound"))
    if bad.filter("n > 1 OR source_id IS NULL OR NOT sound").limit(1).count():
        raise ValueError("source ids must be present and unique, weights between 0 and 10")
    return rows.filter("active")


def write_metrics_csv(stored: DataFrame, graded: DataFrame, path: str, key: str = METRICS_KEY) -> None:
    """Graded reports replace rows of the same key; the export is ordered by date and path. ``stored`` may be read from ``path``: the
    rows are written beside it, and take its place when they are complete."""
    kept = stored.join(graded.select(key), key, "left_anti").unionByName(graded)
    new = f"{path.rstrip('/')}.new"
    kept.orderBy("event_date", "path").write.mode("overwrite").option("header", True).csv(new)
    replace_folder(kept.sparkSession, new, path)


def write_versioned_json(df: DataFrame, path: str) -> DataFrame:
    """(digest, value): rows as JSON under the hash of their content, in folders by the first two digits of it. Content that is
    there already stays as it is and is not written again."""
    text = F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]))
    named = df.select(text.alias("value")).withColumn("digest", F.sha2("value", 256)).dropDuplicates(["digest"])
    new = named.withColumn("prefix", F.substring("digest", 1, 2))
    if exists(df.sparkSession, path):
        new = new.join(read_versioned_json(df.sparkSession, path).select("prefix", "digest"), ["prefix", "digest"], "left_anti")
    new.repartition("prefix").write.mode("append").partitionBy("prefix").json(path)
    return named


def read_versioned_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("digest string, value string, prefix string").json(path)


def append_audit(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


#: Fields that name an element of an array of structs, the first one that it has.
ELEMENT_IDS = ("fight_id", "opponent_style", "tag", "id")


def element_evidence(rows: DataFrame, keys: list[str], section: str, name: str, fields: Sequence[str]) -> DataFrame:
    """(keys, path, section, field, value) of elements that stand as rows: what :func:`long_evidence` gives for the ``fields`` of an array
    ``section`` of them named by ``name``, without ever gathering the array."""
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    long = rows.select(*keys, F.col(name).cast("string").alias("__name"), F.explode(entries).alias("e"))
    return long.select(*keys, F.concat_ws(".", F.lit(section), "__name", "e.field").alias("path"), F.lit(section).alias("section"), "e.field", "e.value")


def long_evidence(df: DataFrame, keys: list[str], ids: Sequence[str] = ELEMENT_IDS) -> DataFrame:
    """(keys, path, section, field, value): a row for every scalar of ``df``, however deep it stands.

    The walk follows the schema: a struct gives its fields, a map its keys, an array of structs its elements by the first of ``ids``
    that they have (else by their place, from 0), so a path is a stable name. Arrays of scalars are one value, as JSON; other
    values are text. What stands below a null struct, array or map has no row; a null scalar has one with a null value.
    """

    def join(prefix: Column | None, name: Column) -> Column:
        name = name.cast("string")
        return name if prefix is None else F.concat(prefix, F.lit("."), name)

    def entry(prefix: Column, value: Column) -> Column:
        return F.array(F.struct(prefix.alias("path"), value.alias("value")))

    none = F.array().cast("array<struct<path:string,value:string>>")

    def walk(prefix: Column | None, value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            parts = [walk(join(prefix, F.lit(f.name)), value[f.name], f.dataType) for f in kind.fields]
            return F.when(value.isNull(), none).otherwise(F.concat(*parts) if parts else none)
        if isinstance(kind, T.MapType):
            below = F.transform(F.map_entries(value), lambda e: walk(join(prefix, e["key"]), e["value"], kind.valueType))
            return F.when(value.isNull(), none).otherwise(F.flatten(below))
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.MapType, T.ArrayType)):
            named = next((i for i in ids if isinstance(kind.elementType, T.StructType) and i in kind.elementType.names), None)
            below = F.transform(value, lambda e, i: walk(join(prefix, e[named] if named else i), e, kind.elementType))
            return F.when(value.isNull(), none).otherwise(F.flatten(below))
        return entry(prefix, F.to_json(value) if isinstance(kind, T.ArrayType) else value.cast("string"))

    parts = [walk(F.lit(f.name), F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields if f.name not in keys]
    long = df.select(*keys, F.explode(F.concat(none, *parts)).alias("e")).select(*keys, "e.path", "e.value")
    section, field = F.substring_index("path", ".", 1), F.substring_index("path", ".", -1)
    return long.select(*keys, "path", section.alias("section"), field.alias("field"), "value")


