"""Secret scan over an incremental blob ledger. DataFrame functions alone.

Every historical version of a text is a blob, addressed by the SHA-256 of its bytes. The ledger is a
Parquet table of (blob, rule, version, findings): a scan reads only (blob, rule, version) triples that
the ledger lacks, appends them, and joins all findings back to every path that holds the blob. Equal
texts are scanned once, a new rule version rescans only itself, and copies cost one row of findings.

Positions come from two functions that see the same matches: the matches themselves and the pieces
between them; the lengths before a match add up to its start, in code points. They are added up in chunks
of matches, so a text's time grows as its length, and the square of its chunks' number, which is tiny.
A blob with very many paths is dealt over SALTS tasks when findings are joined back to paths.

Cases: a null text is the empty blob; null paths and repeated rows get a row each; empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.llm.shared import new_path, stored


@dataclass(frozen=True)
class SecretRule:
    """pattern is searched leftmost and non-overlapping; matches whose measured group is shorter than least are dropped."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1


#: The contract's three kinds first, in their order.
RULES = [
    SecretRule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 1),
    SecretRule("access", r"AKIA[A-Z0-9]+", 18),
    SecretRule("hex", r"[0-9a-f]{16,}+", 16),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++", 24),
    SecretRule("forge", r"(?:gh[pousr]_[A-Za-z0-9]++|glpat-[A-Za-z0-9_-]++|xox[abprs]-[A-Za-z0-9-]++|sk_live_[A-Za-z0-9]++)", 20),
    SecretRule("private_key", r"-----BEGIN (?:(?!PRIVATE KEY)[A-Z]++ )*+PRIVATE KEY-----[A-Za-z0-9+/=\s]*+(?:-----END (?:(?!PRIVATE KEY)[A-Z]++ )*+PRIVATE KEY-----)?", 27),
]

#: Matches that are placed one after the other, and tasks that share a blob's paths.
CHUNK, SALTS = 256, 16

LEDGER = "blob binary, rule string, version int, findings array<struct<start:long,end:long>>"


def rule_spans(text: Column, rule: SecretRule) -> Column:
    """array<struct<start,end>> of the rule's matches in text; [start, end) in code points."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    lengths, sizes = F.transform(whole, F.length), F.transform(part, F.length)
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(whole)), F.arrays_zip(lengths.alias("n"), sizes.alias("m")), lambda gap, x: F.struct(gap.alias("gap"), x["n"].alias("n"), x["m"].alias("m")))
    none = F.from_json(F.lit("[]"), "array<struct<start:long,end:long>>")
    return F.when(text.rlike(rule.pattern), bound(steps, lambda s: placed(s, rule.least, none))).otherwise(none)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def placed(steps: Column, least: int, none: Column) -> Column:
    """The spans of steps (gap before a match, its length n, its measured length m) whose m is at least least."""
    piece = lambda k: F.slice(steps, k * CHUNK + 1, F.lit(CHUNK))
    chunks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / CHUNK).cast("int"))
    long = F.transform(chunks, lambda k: F.aggregate(piece(k), F.lit(0).cast("long"), lambda acc, x: acc + x["gap"] + x["n"]))
    starts = F.aggregate(long, F.array(F.lit(0).cast("long")), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.array(F.struct(start.alias("start"), (start + x["n"]).alias("end")))
        return F.struct((start + x["n"]).alias("at"), F.when(x["m"] >= least, F.concat(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    def spans(at: Column, k: Column) -> Column:
        return F.aggregate(piece(k), F.struct(at.alias("at"), none.alias("found")), step, lambda acc: acc["found"])

    # The last start is the text's end and has no matches after it.
    return F.flatten(bound(starts, lambda all_starts: F.transform(chunks, lambda k: spans(F.get(all_starts, k), k))))


class BlobLedger:
    """The scans done so far, below one folder; runs lists its parts."""

    def __init__(self, spark: SparkSession, path: str, runs: list[str] | None = None):
        self.spark, self.path, self.runs = spark, path.rstrip("/"), list(runs or [])

    def table(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(*self.runs) if self.runs else self.spark.createDataFrame([], LEDGER)

    def scan(self, blobs: DataFrame, rules: list[SecretRule]) -> int:
        """Scan what of blobs (blob, text; blobs may repeat) x rules the ledger lacks. Returns the number of rules that ran.

        A blob counts as seen by a rule version once that version scanned it, with findings or without; what other
        rules or versions scanned doesn't count. A rule runs where it scans one blob at least.
        """
        once = blobs.groupBy("blob").agg(F.any_value("text").alias("text"))
        ran = [F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), rule_spans(F.col("text"), r).alias("findings")) for r in rules]
        if self.runs:
            # One row per blob with all that it has, so that its text is read once for all rules.
            keys = [f"{r.kind}:{r.version}" for r in rules]
            key = F.concat_ws(":", "rule", "version")
            have = self.table().filter(key.isin(keys)).groupBy("blob").agg(F.collect_set(key).alias("have"))
            once = once.join(have, "blob", "left").filter(F.coalesce(F.size("have"), F.lit(0)) < len(set(keys)))
            ran = [F.when(~F.coalesce(F.array_contains("have", k), F.lit(False)), x) for k, x in zip(keys, ran)]
        found = once.select("blob", F.explode(F.filter(F.array(*ran), lambda x: x.isNotNull())).alias("x"))
        run = f"{self.path}/run-{len(self.runs):05d}"
        found.select("blob", "x.rule", "x.version", "x.findings").write.parquet(run)
        self.runs.append(run)
        return self.spark.read.schema(LEDGER).parquet(run).select("rule", "version").distinct().count()

    def findings(self, rules: list[SecretRule]) -> DataFrame:
        """blob -> spans: array<struct<start,rank,end,kind>> in order, for blobs with any."""
        rank = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(k))])
        wanted = F.concat_ws(":", "rule", "version").isin([f"{r.kind}:{r.version}" for r in rules])
        one = self.table().filter(wanted & (F.size("findings") > 0)).select("blob", F.transform("findings", lambda s: F.struct(s["start"].alias("start"), F.element_at(rank, F.col("rule")).alias("rank"), s["end"].alias("end"), F.col("rule").alias("kind"))).alias("spans"))
        # One row per blob and rule, so a blob's list holds its own findings and nothing else.
        return one.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def scan_paths(docs: DataFrame, rules: list[SecretRule] | None = None, ledger: BlobLedger | None = None, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, blob, spans (start, rank, end, kind; by start, then rule order)."""
    rules = rules or RULES
    ledger = ledger or BlobLedger(docs.sparkSession, new_path(docs.sparkSession, "blob-ledger"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    blobs = docs.select(F.col(path_col).alias("id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("blob"))
    ledger.scan(blobs.select("blob", "text"), rules)
    paths = stored(blobs.select("id", "blob"), "paths")
    none = F.from_json(F.lit("[]"), "array<struct<start:long,rank:int,end:long,kind:string>>")
    salted = paths.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    found = ledger.findings(rules).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(found, ["blob", "salt"], "left").select("id", "blob", F.coalesce("spans", none).alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
