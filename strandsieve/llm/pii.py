"""Personal data: exact base patterns, and more identifiers found by bootstrapping from their contexts.

One scan finds the base spans of each text and, beside them, loosely shaped candidates that no base pattern accepts. Each
mention of either sort carries lexical patterns: its kind with the two words before it, and with the word on each side.
Patterns and instances (distinct values) form a graph, which Spark scores in turns: a pattern is as good as the share of
its instances that are accepted, an instance as good as its patterns together; seeds are accepted, others once they are
good enough; the turns go on until no more are. Patterns induced
by enough distinct seeds and of high confidence then discover the candidates they stand beside. Scores use every document;
the graph is aggregated before it is joined, and nothing of it goes to the driver.

Edge cases: null and empty texts have no spans; rows that repeat a doc_id keep their own results; an empty table gives an
empty result; extra columns are ignored; every expression is linear in the text, so very long texts are read whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandsieve.llm.common import discard, tidy_documents, written

KINDS = ("email", "ip", "card", "phone")
#: Distinct seeds that a pattern needs, its least confidence, and turns after which scoring that still changes is an error.
SUPPORT, CONFIDENCE, MOST_TURNS = 3, 0.8, 1000

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive forms that match what the plain ones do: what follows a run of digits is never a digit.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_AT = re.compile(r"[\[(]\s?at\s?[\])]", re.I)

# Loose shapes of candidates, by kind; that of e-mail is what may follow the bracketed sign.
_LOOSE_DOMAIN = re.compile(r"\s?[A-Za-z0-9-]++(?:\s?(?:\.|[\[(]\s?dot\s?[\])])\s?[A-Za-z0-9-]{2,}+)+", re.I)
_LOOSE = (
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[\[(]?\.[\])]?[0-9]{1,3}){3}(?![0-9.])")),
    ("card", re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9A-Za-z])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z+])(?:\([0-9]{2,5}\)|[0-9]{2,5})[ .-][0-9]{3,4}(?:[ .-][0-9]{2,4}){0,2}(?![0-9A-Za-z])")),
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = _local(text, free, at)
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(free, at + 1))


def _is_ip(match: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in match.split("."))


def _is_card(match: str) -> bool:
    digits = match.replace(" ", "").replace("-", "")
    return 14 <= len(digits) <= 19 and luhn(digits)


def _is_phone(match: str) -> bool:
    return 10 <= sum(map(match.count, "0123456789")) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of each base span, in order."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for k, expression, holds in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
            if k != 3 or "+" in text:
                out += [(m.start(), k, m.end()) for m in expression.finditer(text) if holds(m[0])]
    return sorted(out)


def _local(text: str, free: int, end: int) -> int:
    """Where the run of an address's characters before a place starts, found in steps that grow."""
    start = end
    while start > free:
        step = max(free, start - 256)
        start = _LOCAL.search(text, step, start).start()
        if start > step:
            break
    return start


def _loose_emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses with a bracketed sign, their runs before and after it whole."""
    free = 0
    for at in _AT.finditer(text):
        end = at.start() - (at.start() > free and text[at.start() - 1].isspace())
        start = _local(text, free, end)
        while start < end and not text[start].isalnum():
            start += 1
        found = _LOOSE_DOMAIN.match(text, at.end()) if start < end else None
        if found:
            free = found.end()
            yield start, free


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Loosely shaped spans that touch no base span and each other neither."""
    out: list[tuple[int, int, int]] = []
    digits, at = _DIGIT.search(text) is not None, _AT.search(text) is not None
    if not digits and not at:
        return out
    used = bytearray(len(text))
    for s, _, e in taken:
        used[s:e] = b"\1" * (e - s)
    shaped = [(0, _loose_emails(text))] if at else []
    if digits:
        shaped += [(KINDS.index(kind), (m.span() for m in expression.finditer(text))) for kind, expression in _LOOSE]
    for k, found in shaped:
        for s, e in found:
            if used.find(1, s, e) < 0:
                out.append((s, k, e))
                used[s:e] = b"\1" * (e - s)
    return out


def _named(value: str) -> str:
    """A name of bounded length that no other value has."""
    return value if len(value) <= 64 else f"{value[:32]}#{hashlib.blake2b(value.encode(), digest_size=16).hexdigest()}"


def _tidy(words: list[str]) -> list[str]:
    return [_named(w.strip(".,;:!?\"'|()[]{}").lower()) for w in words]


def _before(text: str, start: int) -> list[str]:
    """The two words before a place, whole, or as many as there are."""
    step = 128
    while True:
        got = text[max(0, start - step) : start].split()
        if step >= start or len(got) > 2:  # the first one may be cut
            return _tidy(got[-2:])
        step *= 2


def _after(text: str, end: int) -> list[str]:
    """The word after a place, whole, if there is one."""
    step = 64
    while True:
        got = text[end : end + step].split(None, 2)
        if end + step >= len(text) or len(got) > 1:
            return _tidy(got[:1])
        step *= 2


def patterns(text: str, start: int, kind: int, end: int) -> list[str]:
    before, after = _before(text, start), _after(text, end)
    before = ["^"] * (2 - len(before)) + before
    return [f"{KINDS[kind]}|{before[0]} {before[1]} _", f"{KINDS[kind]}|{before[1]} _ {(after or ['$'])[0]}"]


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
    "mentions array<struct<start:long,kind:int,end:long,value:string,seed:boolean,patterns:array<string>>>"
)


def scan(docs: DataFrame) -> DataFrame:
    """Base results of each row, and its mentions: base and candidate spans with their patterns."""
    mention = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value", pa.string()), ("seed", pa.bool_()), ("patterns", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: list[list[int]] = [[], [], [], []]
            sha, base, mentions = [], [], []
            for text in b.column(1).to_pylist():
                spans = base_spans(text)
                for k in range(4):
                    counts[k].append(sum(x[1] == k for x in spans))
                base.append(shown(spans))
                sha.append(hashlib.sha256(base[-1].encode()).hexdigest())
                mentions.append([
                    {"start": s, "kind": k, "end": e, "value": _named(re.sub(r"[^0-9a-z@.]", "", text[s:e].lower())), "seed": seed, "patterns": patterns(text, s, k, e)}
                    for seed, some in ((True, spans), (False, candidates(text, spans)))
                    for s, k, e in some
                ])
            yield pa.record_batch(
                [b.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(sha, pa.string()), pa.array(base, pa.string()), pa.array(mentions, pa.list_(mention))],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "mentions"],
            )

    return tidy_documents(docs).mapInArrow(run, _FOUND)


def score_patterns(edges: DataFrame) -> DataFrame:
    """pattern, confidence and number of distinct seeds, from distinct (pattern, instance, seed) edges (a written table).

    A turn never takes back what one before accepted, so the turns end when the number of accepted instances stands still.
    """
    known = edges.groupBy("instance").agg(F.max(F.when(F.col("seed"), 1.0).otherwise(0.0)).alias("belief"))
    path, accepted = None, -1
    for _ in range(MOST_TURNS):
        # A turn: accepted instances to patterns (their share), and back (one minus the product of doubts).
        per = _confidence(edges, known)
        trusted = F.when(F.col("seeds") >= SUPPORT, F.least(F.col("confidence"), F.lit(0.999))).otherwise(0.0)
        doubts = edges.join(per, "pattern").groupBy("instance").agg(
            F.max("seed").alias("seed"), F.exp(F.sum(F.log(1 - trusted))).alias("doubt")
        )
        new, new_path = written(doubts.select("instance", F.when(F.col("seed"), 1.0).otherwise(F.round(1 - F.col("doubt"), 9)).alias("belief")), "beliefs")
        if path:
            discard(edges.sparkSession, path)
        known, path = new, new_path
        before, accepted = accepted, known.where(F.col("belief") >= CONFIDENCE).count()
        if accepted == before:
            return _confidence(edges, known)
    raise RuntimeError(f"beliefs still change after {MOST_TURNS} turns")


def _confidence(edges: DataFrame, known: DataFrame) -> DataFrame:
    accepted = F.when(F.col("belief") >= CONFIDENCE, 1.0).otherwise(0.0)
    return edges.join(known, "instance").groupBy("pattern").agg(F.avg(accepted).alias("confidence"), F.sum(F.when(F.col("seed"), 1).otherwise(0)).alias("seeds"))


def find_personal_data(docs: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone and base_sha256 of base spans; spans: all; n_found: those discovered."""
    found, _ = written(scan(docs).withColumn("_row", F.monotonically_increasing_id()), "mentions")
    mentions = found.select("_row", F.explode("mentions").alias("m")).select("_row", "m.*")
    instance = F.concat_ws("|", F.col("kind").cast("string"), "value")
    edges, _ = written(
        mentions.select(F.explode("patterns").alias("pattern"), instance.alias("instance"), "seed").groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "edges"
    )
    # Patterns that no candidate stands beside can discover nothing, and instances of those only are sure anyway.
    open_patterns = edges.groupBy("pattern").agg(F.max(~F.col("seed")).alias("_open"), F.sum(F.when(F.col("seed"), 1).otherwise(0)).alias("_seeds")).where(F.col("_open") & (F.col("_seeds") >= support))
    live, _ = written(edges.join(open_patterns.select("pattern"), "pattern", "left_semi"), "live")
    extra = found.select("_row").where("false").withColumn("added", F.lit(None).cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    if not live.isEmpty():
        good, _ = written(score_patterns(live).where((F.col("seeds") >= support) & (F.col("confidence") >= confidence)), "patterns")
        fresh = mentions.where(~F.col("seed")).withColumn("pattern", F.explode("patterns")).join(good, "pattern", "left_semi")
        extra = fresh.groupBy("_row").agg(F.collect_set(F.struct("start", "kind", "end")).alias("added"))
    base = F.transform(F.filter("mentions", lambda m: m["seed"]), lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")))
    names = F.array(*[F.lit(k) for k in KINDS])
    whole = F.array_sort(F.concat(base, F.coalesce("added", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))))
    text = F.array_join(F.transform(whole, lambda m: F.concat_ws(":", names[m["kind"]], m["start"].cast("string"), m["end"].cast("string"))), ",")
    return found.join(extra, "_row", "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", text.alias("spans"), F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_found")
    )


__all__ = ["KINDS", "base_spans", "candidates", "find_personal_data", "luhn", "patterns", "scan", "score_patterns", "shown"]
