"""Secret scan with corpus-wide ownership frequency.

Every text is scanned for three kinds of base matches (assign, access, hex) and
for other long tokens that look random. The hash of every value found is then
aggregated over the whole corpus: in how many repositories and under how many
owners does it occur? A value under more than ``max_owners`` owners, or in more than
``max_repos`` repositories (an owner may copy a sample into all of its own), is a widely
copied example; one that is specific to few and looks live is a credential.
Live tokens outside the base matches become further spans, kind ``owned``.

Null texts count as empty. Owners and repositories may be null (one value of its
own). Repeated rows each get their row; copies of a repository count once. Values
never leave the scan: only their hashes are shuffled or stored.
"""

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame, functions as F

from ordertide.llm.common import map_rows, quoted, type_of
from ordertide.sources.scratch import settle

# The base patterns, in the order in which kinds are listed.
KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
OWNED = "owned"

FOUND = "array<struct<kind:string,start:long,end:long,hash:binary,live:boolean>>"


def base_matches(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value), leftmost and non-overlapping per kind."""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text)
                  if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)
                  if len(m[0]) >= MIN_ACCESS]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    found.sort(key=lambda f: (f[1], KINDS.index(f[0])))
    return found


def looks_live(value: str, bits: float = 3.0) -> bool:
    """Random-looking: letters and digits mixed, and at least ``bits`` bits a character."""
    if not any(c.isdigit() for c in value) or not any(c.isalpha() for c in value):
        return False
    n = len(value)
    return sum(-c / n * math.log2(c / n) for c in Counter(value).values()) >= bits


def other_tokens(text: str, base: list) -> list[tuple[str, int, int, str]]:
    """Long tokens that look live and touch no base match."""
    found, taken, at, reach = [], sorted((b[1], b[2]) for b in base), 0, 0
    for m in TOKEN.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            reach, at = max(reach, taken[at][1]), at + 1
        if reach <= m.start() and looks_live(m[0]):
            found.append((OWNED, m.start(), m.end(), m[0]))
    return found


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, *_ in spans)


def _scan():
    def step(batch):
        founds = []
        for text in batch.column(3).to_pylist():
            text = text or ""
            base = base_matches(text)
            founds.append([
                {"kind": k, "start": s, "end": e, "live": looks_live(v),
                 "hash": hashlib.sha256(v.encode("utf-8", "surrogatepass")).digest()}
                for k, s, e, v in base + other_tokens(text, base)])
        return [batch.column(0), batch.column(1), batch.column(2), founds]

    return step


def scan(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """Columns id, owner, repo and found (base matches and candidate tokens) of each row."""
    rows = docs.select(quoted(id_col).alias("id"), quoted(owner_col).cast("string").alias("owner"),
                       quoted(repo_col).cast("string").alias("repo"), quoted(text_col).alias("text"))
    return map_rows(rows, _scan, f"id {type_of(rows, 'id')}, owner string, repo string, found {FOUND}")


def ownership(scanned: DataFrame) -> DataFrame:
    """Columns hash, owners, repos: distinct owners and repositories of each value.

    Three aggregates, each combined before its shuffle, so a value copied into a
    third of all repositories is spread over them by (hash, owner, repo) first.
    """
    seen = scanned.select("owner", "repo", F.explode("found.hash").alias("hash"))
    each = seen.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("times"))
    per_owner = each.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return per_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 owner_col: str = "source", repo_col: str = "doc_id",
                 max_owners: int = 2, max_repos: int = 50) -> DataFrame:
    """Columns ``id_col`` and spans: array of kind, start, end, owners, repos, verdict.

    ``verdict`` is "live" (looks random, at most ``max_owners`` owners and ``max_repos``
    repositories), "example" (more of either) or "plain" (few, does not look random). Base matches keep
    their kind whatever the verdict; other tokens are listed only when live. Spans
    are sorted by start, then base kinds as listed, then ``owned``.
    """
    row_key = F.monotonically_increasing_id()
    scanned = settle(scan(docs, id_col, text_col, owner_col, repo_col).withColumn("row", row_key))
    known = ownership(scanned)
    spans = scanned.select("row", F.explode("found").alias("f")).select("row", "f.*")
    wide = (F.col("owners") > max_owners) | (F.col("repos") > max_repos)
    judged = spans.join(known, "hash").withColumn(
        "verdict", F.when(wide, "example").when(F.col("live"), "live").otherwise("plain"))
    kept = judged.filter((F.col("kind") != OWNED) | (F.col("verdict") == "live"))
    rank = F.array_position(F.array(*[F.lit(k) for k in [*KINDS, OWNED]]), F.col("kind"))
    per_row = kept.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "start", rank.alias("rank"), "kind", "end", "owners", "repos", "verdict"))).alias("spans"))
    empty = F.expr("cast(array() as array<struct<start:long,rank:long,kind:string,end:long,"
                   "owners:long,repos:long,verdict:string>>)")
    return scanned.select("row", "id").join(per_row, "row", "left").select(
        F.col("id").alias(id_col), F.coalesce("spans", empty).alias("spans"))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of base matches, the digest of their spans, and all spans as text."""
    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(field, value):
        return F.size(F.filter("spans", lambda s: s[field] == value)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != OWNED)
    return found.select(
        F.col(id_col),
        *[count("kind", k).alias(f"n_{k}") for k in KINDS],
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
        count("verdict", "live").alias("n_live"),
        count("verdict", "example").alias("n_example"))
