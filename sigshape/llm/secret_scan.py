"""Secret scans: fixed patterns, and two character Markov models.

Fixed patterns give the base spans. The method adds spans: runs of key
characters outside the base spans (a run that a base span cuts is looked at in
its parts) of at least ``MIN_LENGTH`` characters are scored by the
log-likelihood ratio of two first-order character models. Random strings are
learned from the values of the base spans, the labelled secrets, and mixed
with equal chances, since a corpus may show one kind of secret only. Ordinary
identifiers are learned from two labelled samples: runs of at least ``MIN_WORD``
key characters outside the base spans whose parts between separators are
letters, then digits (other runs may be secrets), and ``NAMES``, identifiers of
the kinds that those leave out: digits before letters, capitals inside. The
names give how kinds of characters follow one another, with equal chances
within a kind, and ``NAMES_SHARE`` of the model; so no step that names make
costs much in a corpus that happens not to show it, and a score does not
hang on the corpus's size. A run whose ratio reaches ``MIN_RATIO`` nats is a
span of kind ``markov``. Both models count every document; they are tables of
128 x 128 pairs, whatever the corpus.

DataFrame functions only. Positions come from splitting the text at the
matches: a match starts after the parts and matches before it. Only texts
with a match are split.

Defined cases: a null or empty text has no spans; offsets are code points,
ends exclusive; a pattern that would match too short a value still consumes
it (leftmost, non-overlapping), then it is dropped; without base spans
random strings are equal chances alone, without ordinary runs the names
alone are ordinary; repeated rows give repeated rows; an empty table gives no
rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: Fixed patterns, by kind.
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
MIN_VALUE = 6

KEY_CHARACTERS = "A-Za-z0-9+/_=-"
ALPHABET = 67                 # key characters and one for the rest
MIN_LENGTH = 20
MIN_WORD = 12
MIN_RATIO = 12.0
#: What no part of an ordinary identifier of a corpus has: a letter right after a digit.
NOT_ORDINARY = "[0-9][A-Za-z]"
#: Share of the names in the model of ordinary identifiers, and of equal chances in that of random strings.
NAMES_SHARE, EQUAL_SHARE = 0.25, 0.5
#: Ordinary identifiers with digits before letters or capitals inside.
NAMES = """
sha256sum md5sum base64 utf8mb4_0900_ai_ci x86_64-linux-gnu arm64-v8a i386 win32 amd64 h264_1080p_60fps mp3 720p 2ch 3d-model 2d
1st-place 2nd 3rd-party 4th v1beta1 v2alpha1 ipv4 ipv6 http2 web3 k8s-cluster i18n l10n a11y s3-bucket ec2-instance oauth2_token_url
log4j2 python3 py38-linux java8 es2015 html5 css3 covid19 q3fy24 b2b c4 d3js p95_latency_ms m1 10gb 4k 8k 100ms 30s 24h 7d 12px 2x
usb3 ddr4 getUserById setAccountName parseJSON toString XMLHttpRequest MyClassName isValidUserToken DataFrameReader MAX_RETRY_COUNT
README_EN HTTP_STATUS_CODE LOG_LEVEL_DEBUG ENV_VAR_NAME org/apache/spark/sql home/user/docs build-and-test snake_case_name
release-3rc2 build7b sars2 part2b_final chapter-10a 2ndversion 5mbps_aac h265 vp9
"""
#: Kinds of key characters, and how many there are of each; the last is separators.
KINDS = {"lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "mark": "+/_=-"}
CODES = 128


NO_SPANS = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def _with_spans(rows: DataFrame, pattern: str, kind: int, name: str) -> DataFrame:
    """``rows`` with the array ``name`` of (start, kind, end, value) of a
    pattern's matches in ``text``. Matches and the parts between them are
    columns of their own, so that each is computed once for a text."""
    none = F.array().cast("array<string>")
    rows = rows.withColumn("_hits", F.when(F.regexp_like("text", F.lit(pattern)),
                                           F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    rows = rows.withColumn("_parts", F.when(F.size("_hits") > 0, F.split("text", pattern, -1)).otherwise(none))
    empty = F.array().cast(NO_SPANS)
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("out"))

    def step(acc: Column, i: Column) -> Column:
        start = acc["at"] + F.char_length(F.get("_parts", i)).cast("bigint")
        end = start + F.char_length(F.get("_hits", i)).cast("bigint")
        one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
                       F.get("_hits", i).alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    found = F.aggregate(F.sequence(F.lit(0), F.size("_hits") - 1), zero, step, lambda acc: acc["out"])
    return rows.withColumn(name, F.when(F.size("_hits") > 0, found).otherwise(empty)).drop("_hits", "_parts")


def _codes(token: Column) -> Column:
    """The pairs of a token's characters, as first * 128 + second."""
    chars = F.transform(F.split(token, ""), lambda c: F.ascii(c))
    return F.filter(F.transform(chars, lambda c, i: c * CODES + F.get(chars, i + 1)), lambda p: p.isNotNull())


def _counts(tokens: DataFrame) -> dict[int, int]:
    """How often each pair occurs in ``token``; at most CODES * CODES rows."""
    pairs = tokens.select(F.explode(_codes(F.col("token"))).alias("p")).where(F.col("p").between(0, CODES * CODES - 1))
    return {r.p: r.n for r in pairs.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}


def _table(counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Chances of the second character after the first, and whether the first was seen."""
    n = np.zeros((CODES, CODES))
    for p, k in counts.items():
        n[p // CODES, p % CODES] += k
    begun = n.sum(axis=1, keepdims=True)
    return n / np.maximum(begun, 1), begun > 0


def names_chances() -> np.ndarray:
    """The model of ``NAMES``: kinds follow one another as they do there (half a
    step more each), equal chances within a kind."""
    kinds = list(KINDS.values())
    of = {c: k for k, cs in enumerate(kinds) for c in cs}
    steps = np.full((len(kinds), len(kinds)), 0.5)
    for name in NAMES.split():
        for a, b in zip(name, name[1:]):
            steps[of[a], of[b]] += 1
    steps /= steps.sum(axis=1, keepdims=True)
    out = np.zeros((CODES, CODES))
    for a, i in of.items():
        for b, j in of.items():
            out[ord(a), ord(b)] = steps[i, j] / len(kinds[j])
    return out


def log_ratios(random: dict[int, int], ordinary: dict[int, int]) -> np.ndarray:
    """Log-likelihood ratio of every pair: random strings against ordinary
    ones; 0 for pairs that no key has."""
    (secret, seen), (corpus, known) = _table(random), _table(ordinary)
    names = names_chances()
    a = np.where(seen, (1 - EQUAL_SHARE) * secret + EQUAL_SHARE / ALPHABET, 1 / ALPHABET)
    b = np.where(known, (1 - NAMES_SHARE) * corpus + NAMES_SHARE * names, names)
    return np.where(names > 0, np.log(a) - np.log(np.where(names > 0, b, 1)), 0.0).reshape(-1)


def with_base_spans(rows: DataFrame) -> DataFrame:
    """``rows`` with ``base``: spans of the fixed patterns, by start, then kind."""
    for kind, (name, pattern) in enumerate((("_assign", ASSIGN), ("_access", ACCESS), ("_hex", HEX))):
        rows = _with_spans(rows, pattern, kind, name)
    # A match of the assignment pattern counts by its value's length.
    assign = F.filter("_assign", lambda s: F.char_length(F.regexp_extract(s["value"], ASSIGN, 2)) >= MIN_VALUE)
    return rows.withColumn("base", F.array_sort(F.concat(assign, "_access", "_hex"))).drop("_assign", "_access", "_hex")


def _joined(spans: Column, names: list[str]) -> Column:
    name = lambda k: F.get(F.array(*[F.lit(x) for x in names]), k)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _outside(spans: Column, base: Column, least: int) -> Column:
    """``spans`` without what ``base`` covers: whole ones, or their parts, of
    ``least`` characters or more."""
    none = F.array().cast(NO_SPANS)
    cut = lambda s, b: (b["start"] < s["end"]) & (s["start"] < b["end"])

    def part(s: Column, start: Column, end: Column) -> Column:
        value = F.substr(s["value"], (start - s["start"] + 1).cast("int"), (end - start).cast("int"))
        return F.struct(start.alias("start"), s["kind"].alias("kind"), end.alias("end"), value.alias("value"))

    def parts(s: Column) -> Column:
        zero = F.struct(s["start"].alias("at"), none.alias("out"))

        def step(acc: Column, b: Column) -> Column:
            more = F.when(b["start"] > acc["at"], F.array(part(s, acc["at"], b["start"]))).otherwise(none)
            return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), F.concat(acc["out"], more).alias("out"))

        return F.aggregate(F.filter(base, lambda b: cut(s, b)), zero, step, lambda acc: F.when(
            acc["at"] < s["end"], F.concat(acc["out"], F.array(part(s, acc["at"], s["end"])))).otherwise(acc["out"]))

    split = F.flatten(F.transform(spans, lambda s: F.when(F.exists(base, lambda b: cut(s, b)), parts(s)).otherwise(F.array(s))))
    return F.filter(split, lambda s: s["end"] - s["start"] >= least)


def train_ratios(rows: DataFrame) -> np.ndarray:
    """Learns both models from ``rows`` (text): every document counts."""
    spans = with_base_spans(rows)
    secret = spans.select(F.explode("base").alias("s")).select(
        F.when(F.col("s.kind") == 0, F.regexp_extract("s.value", ASSIGN, 2)).otherwise(F.col("s.value")).alias("token"))
    runs = _with_spans(spans, f"[{KEY_CHARACTERS}]{{{MIN_WORD},}}", 3, "runs")
    ordinary = (runs.select(F.explode(_outside(F.col("runs"), F.col("base"), MIN_WORD)).alias("s")).select(F.col("s.value").alias("token"))
                .where(~F.col("token").rlike(NOT_ORDINARY)))
    return log_ratios(_counts(secret), _counts(ordinary))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256,
    spans, n_markov."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    ratios = train_ratios(rows)
    table = F.from_json(F.lit(str([round(float(x), 6) for x in ratios])), F.lit("array<double>"))
    run = f"[{KEY_CHARACTERS}]{{{MIN_LENGTH},}}"

    def ratio(value: Column) -> Column:
        return F.aggregate(_codes(value), F.lit(0.0), lambda acc, p: acc + F.coalesce(F.get(table, p), F.lit(0.0)))

    found = _with_spans(with_base_spans(rows), run, 3, "runs")
    found = found.select("doc_id", "base", F.filter(_outside(F.col("runs"), F.col("base"), MIN_LENGTH),
                                                    lambda s: ratio(s["value"]) >= MIN_RATIO).alias("markov"))
    names = ["assign", "access", "hex", "markov"]
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(_joined(F.col("base"), names), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "markov")), names).alias("spans"),
        F.size("markov").cast("bigint").alias("n_markov"))
