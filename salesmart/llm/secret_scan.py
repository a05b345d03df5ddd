"""Secret scans: an incremental ledger of blobs.

Every version of a text is a blob, named by its SHA-256. The ledger remembers which rule version
has scanned which blob, so a text that was seen before, under any path, is scanned only by rules
that are new or changed. Findings are kept per blob and joined back to all paths.

Below ``root`` in shared storage: ``paths`` (path to blob), ``scanned`` (blob, rule, version) and
``findings`` (blob, rule, version, start, end, in code points, end exclusive), each by commit, and
``commits``, which names the complete ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from salesmart.llm.common import commit, committed


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count if ``secret`` (a group of the match) has ``min_chars``.

    Matches are leftmost and do not overlap; short ones are dropped afterwards, so they still use
    up their text.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    min_chars: int = 0


# Fixed values. In `access` and `hex` the least length is part of the pattern: a match is a whole
# run of its characters, so a shorter run cannot hide a longer match.
RULES = (
    Rule(
        "assign",
        1,
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        min_chars=6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

PIECES = "array<struct<steps:bigint,hit:bigint,ok:boolean>>"


def pieces(text: Column, rule: Rule) -> Column:
    """The lengths of a rule's matches in ``text``, each with the step from the end of the one before.

    The parts between matches and the matches themselves alternate, so a match ends at the sum of
    all steps up to its own.
    """
    pattern = F.lit(rule.pattern)
    hits = F.regexp_extract_all(text, pattern, 0)
    zipped = F.arrays_zip(
        F.slice(F.split(text, rule.pattern, -1), 1, F.size(hits)).alias("gap"),
        hits.alias("hit"),
        F.regexp_extract_all(text, pattern, rule.group).alias("secret"),
    )
    lengths = F.transform(
        zipped,
        lambda p: F.struct(
            (F.length(p["gap"]) + F.length(p["hit"])).cast("long").alias("steps"),
            F.length(p["hit"]).cast("long").alias("hit"),
            (F.length(p["secret"]) >= rule.min_chars).alias("ok"),
        ),
    )
    return F.when(F.regexp_like(text, pattern), lengths).otherwise(F.array().cast(PIECES))


class BlobLedger:
    """The ledger's tables below ``root``; a new folder is an empty ledger.

    A ledger that is opened again goes on after the last complete commit; what a broken one left is
    written over. One writer at a time: a second one of the same commit is refused.
    """

    PATHS = "path long, blob binary"
    SCANNED = "blob binary, kind string, version int"
    FINDINGS = "blob binary, kind string, version int, start long, end long"

    def __init__(self, spark: SparkSession, root: str, rules: Sequence[Rule] = RULES):
        self.spark, self.root, self.rules = spark, root.rstrip("/"), tuple(rules)
        self.commits, _ = committed(spark, self.root)

    def _read(self, name: str, schema: str, before: int) -> DataFrame:
        folders = [f"{self.root}/{name}/commit={n}" for n in range(before)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def scan(self, versions: DataFrame) -> None:
        """Take in a commit of ``versions`` (path, text): scan what no earlier commit scanned."""
        n = self.commits
        blobs = versions.select("path", "text", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("blob"))
        blobs.select("path", "blob").write.mode("overwrite").parquet(f"{self.root}/paths/commit={n}")
        paths = self.spark.read.schema(self.PATHS).parquet(f"{self.root}/paths/commit={n}")

        # One path of every blob holds its text for the scan.
        holders = paths.groupBy("blob").agg(F.min("path").alias("path"))
        wanted = F.array(
            *[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in self.rules]
        )
        pairs = holders.select("blob", "path", F.explode(wanted).alias("r")).select("blob", "path", "r.*")
        unseen = pairs.join(self._read("scanned", self.SCANNED, n), ["blob", "kind", "version"], "left_anti")
        unseen.write.mode("overwrite").parquet(f"{self.root}/scanned/commit={n}")
        todo = (
            self.spark.read.schema(f"{self.SCANNED}, path long")
            .parquet(f"{self.root}/scanned/commit={n}")
            .groupBy("blob", "path")
            .agg(F.collect_set(F.struct("kind", "version")).alias("todo"))
        )
        found = F.array(
            *[
                F.struct(
                    F.lit(r.kind).alias("kind"),
                    F.lit(r.version).alias("version"),
                    F.when(
                        F.array_contains(
                            F.col("todo"), F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"))
                        ),
                        pieces(F.col("text"), r),
                    ).otherwise(F.array().cast(PIECES)).alias("pieces"),
                )
                for r in self.rules
            ]
        )
        texts = versions.select(F.col("path").alias("_path"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
            "_blob", F.unhex(F.sha2("text", 256))
        )
        # One row per match; only lengths leave the task that reads the text.
        hits = (
            texts.join(todo, F.col("_path").eqNullSafe(F.col("path")) & (F.col("_blob") == F.col("blob")))
            .select(F.monotonically_increasing_id().alias("_row"), "blob", F.explode(found).alias("f"))
            .select("_row", "blob", "f.kind", "f.version", F.posexplode("f.pieces").alias("_at", "p"))
        )
        up_to = Window.partitionBy("_row", "kind").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
        end = F.sum("p.steps").over(up_to)
        # Rows that repeat a path and its text would repeat the findings: distinct after the scan.
        (
            hits.select("blob", "kind", "version", (end - F.col("p.hit")).alias("start"), end.alias("end"), F.col("p.ok").alias("_ok"))
            .filter("_ok")
            .drop("_ok")
            .distinct()
            .write.mode("overwrite")
            .parquet(f"{self.root}/findings/commit={n}")
        )
        commit(self.spark, self.root, n)
        self.commits += 1

    def findings(self) -> DataFrame:
        """``blob`` and its findings of the current rules, one row per blob that has any."""
        current = F.lit(False)
        for r in self.rules:
            current = current | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
        return (
            self._read("findings", self.FINDINGS, self.commits)
            .filter(current)
            .groupBy("blob")
            .agg(F.collect_list(F.struct("start", "end", "kind")).alias("found"))
        )

    def report(self) -> DataFrame:
        """``path, blob, found`` for every version taken in; ``found`` is null without findings.

        A blob that most paths share is one row of findings; the paths are the side that the
        planner splits if one blob is hot.
        """
        return self._read("paths", self.PATHS, self.commits).join(self.findings(), "blob", "left")


def scan_documents(docs: DataFrame, root: str, commits: int = 2, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Scan ``docs`` (doc_id, text) through a ledger at ``root``; ``doc_id, found`` per row.

    The documents arrive as ``commits`` commits, dealt by a hash of the doc_id. Null texts are empty texts.
    A null doc_id is a path like any other. Repeated rows are repeated in the result, with the
    same findings. The places of a text's matches are running sums, so a very long text with very
    many secrets costs in proportion. An empty table gives an empty result. Other columns are not read.
    """
    ledger = BlobLedger(docs.sparkSession, root, rules)
    versions = docs.select(F.col("doc_id").cast("long").alias("path"), F.col("text").cast("string").alias("text"))
    part = F.pmod(F.xxhash64("path"), F.lit(commits))
    for n in range(commits):
        ledger.scan(versions.filter(part == n))
    return ledger.report().select(F.col("path").alias("doc_id"), "found")


def digest(found: DataFrame, rules: Sequence[Rule] = RULES, base: Sequence[str] = ("assign", "access", "hex")) -> DataFrame:
    """Counts per base kind and the spans as text, ordered by start and then by rule."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    ranked = F.transform(
        F.coalesce("found", F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")),
        lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")),
    )

    def joined(items: Column) -> Column:
        return F.array_join(
            F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def of_kinds(*kinds: str) -> Column:
        return F.filter("_s", lambda s: s["kind"].isin(*kinds))

    return found.select("doc_id", F.sort_array(ranked).alias("_s")).select(
        "doc_id",
        *[F.size(of_kinds(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(joined(of_kinds(*base)), 256).alias("base_sha256"),
        joined(F.col("_s")).alias("spans"),
    )
