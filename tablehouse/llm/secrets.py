"""Operator 8: secret scans, with a random forest that removes false findings.

Candidates are runs of token characters of at least `LONG` bytes, and assigned values of at
least `SHORT`: what follows the first `:` or `=`, up to the closing quote, a space or, unquoted,
the next `&name=` (also `;` and `,`); signs that end a sentence or close a bracket are cut off
where no quote opened the value.  An assigned value holds visible ASCII and the two-byte letters
(Latin, Greek, Cyrillic).  Its pieces between further signs, before an `@` and of token
characters only are candidates too.  Of kept findings that lie inside each other the outermost
is reported.  Each candidate gets features: its length and mix of characters,
character transitions (changes of class, and how usual its letter pairs are in words), the
share of it that dictionary words cover, whether it looks like a path, and what the words
around it are.  A random forest (Spark's) trained on labelled findings decides.

Labelled findings (columns text, first, last, label) are a parameter.  Where none are given,
`labelled_findings` makes them: values of published credential formats, and look-alikes
(identifiers, check sums, paths, numbers, long words), both placed behind different words; to
these come candidates from a sample of about `SAMPLE_DOCS` distinct documents at most, as far as
a rule labels them clearly: a random value assigned to a credential's name is a secret; digits
alone, words, and check sums assigned to a harmless name are none.  All others, among them
published formats and random values without a name, are left out of training, so a source full
of them teaches nothing.  Only the sample is bounded; the scan covers every text.

Defined cases: null texts have no candidates; positions count characters of the text; a value
that occurs twice is reported twice; repeated rows are reported each; null doc_ids stay null;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablehouse.llm.common import byte_runs, fit, prepare, slices, spare, utf8

LONG, SHORT, CONTEXT = 16, 8, 48
SAMPLE_DOCS, TREES, DEPTH, SEED = 4000, 30, 8, 7
MASK = "[SECRET]"
PUBLISHED = re.compile(  # published formats of credentials
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36}|github_pat_\w{22}|glpat-[\w-]{20}|xox[abprs]-\d{10,}-[\w-]{10}|[rs]k_(?:live|test)_[A-Za-z0-9]{16}"
    r"|sk-(?:[a-z]+-)?[A-Za-z0-9_]{20}|AIza[\w-]{35}|npm_[A-Za-z0-9]{36}|eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{8}|SG\.[\w-]{16,}\.[\w-]{16})")
CODE = re.compile(r"[(){}\[\]<>$\\]|://|[=:&;,]\w+[=:]")  # expressions and addresses rather than values

# fixed values: names that credentials are assigned to, names of harmless random values, and a small dictionary
NAMES = ("token secret password passwd pwd passphrase credential credentials apikey api_key api-key access_key access-key accesskey auth "
         "authorization bearer private_key secret_key client_secret signing key pat session cookie").split()
HARMLESS = "sha1 sha256 sha512 md5 checksum digest hash commit uuid guid etag revision integrity fingerprint id isbn order invoice phone version build file path".split()
WORDS = ("about access account action active address admin after agent allow alpha answer apply array article author auto back base basic before begin beta between block "
         "body book branch buffer build button byte cache call card case change char check child class clean click client clock close cloud code color column command common "
         "config connect content control copy count create custom daily data date debug default define delete demo design detail device digit direct disable display document "
         "domain down edit email enable engine enter entry error event example execute exist export extension factory false field file filter final find first float folder "
         "font foot form format forward frame from function general get global group hand handle hash head header hello help hidden high home host hour html http icon image "
         "import index info init input insert install integer inter item join json just kernel label language last layer layout left length level library light line link list "
         "load local location lock login long machine main manager map mark master match member memory menu message meta method mind model module month more move name native "
         "network node normal note null number object offset open option order other output page panel parent part pass path pattern place plain play plugin point pool port "
         "post process product profile project property public query queue random range read record region register release remote remove report request reset resource "
         "response result return right root route rule sample scale schema screen script search select send sequence server service session settings share shell short show "
         "sign simple single size socket software source space special stack standard start state static status step stop storage store stream string style submit super "
         "switch symbol system table tag target task temp template test text theme thread time title toggle tool total track transfer tree trigger type under unit update "
         "upload user utility valid value variable vector version video view visible wait watch web week width window word work world write year zone the and ing tion ment").split()


def _classes() -> np.ndarray:
    inside = np.zeros(256, bool)
    for a, b in ((48, 58), (65, 91), (97, 123)):
        inside[a:b] = True
    inside[[ord(c) for c in "_-+/=."]] = True
    return inside


# an assignment with what may stand before its value, and values by the quote that opens them
SIGN = re.compile(rb"[=:]+>?[ \t]{0,%d}([\"'`]?)" % CONTEXT)
_LETTER = rb"[\xc3-\xd4][\x80-\xbf]"
VALUES = {q: re.compile(rb"(?:[^\x00-\x20\x7f-\xff" + q + rb"]++|" + _LETTER + rb")*+") for q in (b'"', b"'", b"`")}
VALUES[b""] = re.compile(rb"(?:[^\x00-\x20\x7f-\xff\"'`&;,]++|" + _LETTER + rb"|[&;,](?![A-Za-z_][\w.-]{0,63}[=:]))*+")
PIECE = re.compile(rb"[^=:]+(?:=+\Z)?")
CLOSING = b".,;:)]}>\\"


def _split(a: int, piece: bytes) -> list[tuple[int, int]]:
    """A value, its parts between signs (padding at the end is no sign) and those before an @."""
    spans = [(0, len(piece)), *(m.span() for m in PIECE.finditer(piece))]
    spans += [(x, at) for x, y in spans[1:] if (at := piece.rfind(b"@", x, y)) > x]
    return [(a + x, a + y) for x, y in spans if y - x >= SHORT]


def _assigned(data: bytes, off: np.ndarray) -> list[tuple[int, int]]:
    """First byte and byte after the last of assigned values and of their pieces."""
    out, done = [], 0
    for m in SIGN.finditer(data):
        a = m.end()
        if a < done:  # inside a value, whose pieces are there
            continue
        end = int(off[np.searchsorted(off, m.start(), "right")])
        if a >= end:
            continue
        done = VALUES[m[1]].match(data, a, end).end()
        if done - a >= SHORT:
            piece = data[a:done]
            out += _split(a, piece if m[1] else piece.rstrip(CLOSING))
    return out


def candidates(column: pa.Array) -> list[tuple[int, int, int]]:
    """(row, first byte, byte after the last) of every candidate, within its row, outer ones first."""
    data, off = utf8(column)
    starts, ends = byte_runs(data, off, _classes())
    # trailing signs that end a sentence or a query are no part of a value
    for _ in range(3):
        last = data[np.maximum(ends - 1, 0)]
        cut = (ends - starts > 1) & ((last == 46) | (last == 45) | (last == 95))
        ends = ends - cut
    row_start = off[np.searchsorted(off, starts, "right") - 1]
    head = np.zeros(len(starts), bool)
    for back in (1, 2, 3):  # name="value, name: "value, name = value
        place = starts - back
        head |= (place >= row_start) & np.isin(data[np.maximum(place, 0)], (58, 61))
    # name=value is one run: its value begins after the sign
    signs = np.concatenate(([0], np.cumsum(data == 61)))
    size = ends - starts
    keep = np.flatnonzero((size >= LONG) | ((size >= SHORT) & (head | (signs[ends] > signs[starts]))))
    raw = data.tobytes()
    found = set(_assigned(raw, off))
    for a, b, assigned in zip(starts[keep].tolist(), ends[keep].tolist(), head[keep].tolist(), strict=True):
        piece = raw[a:b]
        sign = piece.find(b"=")
        if 0 < sign < len(piece.rstrip(b"=")) - 1:
            after = sign + 1
            found.update(_split(a + after, piece[after:]))
            piece = piece[:sign]
        if len(piece) >= (SHORT if assigned else LONG):
            found.add((a, a + len(piece)))
    spans = sorted(found, key=lambda s: (s[0], -s[1]))
    rows = np.searchsorted(off, [a for a, _ in spans], "right") - 1
    return [(r, a - int(off[r]), b - int(off[r])) for r, (a, b) in zip(rows.tolist(), spans, strict=True)]


def _pairs() -> dict[str, float]:
    """Log share of each letter pair in the dictionary."""
    counts: dict[str, int] = {}
    for w in WORDS:
        for a, b in zip(w, w[1:], strict=False):
            counts[a + b] = counts.get(a + b, 0) + 1
    total = sum(counts.values())
    return {k: math.log(v / total) for k, v in counts.items()}


class Measures:
    """Feature values of a candidate in its surroundings."""

    def __init__(self):
        self.pairs = _pairs()
        self.words = re.compile("|".join(sorted((w for w in WORDS if len(w) > 2), key=len, reverse=True)))
        self.names, self.harmless = set(NAMES), set(HARMLESS)
        self.split = re.compile(r"[A-Za-z0-9_-]+").findall

    def of(self, value: str, before: str, after: str) -> list[float]:
        n = len(value)
        low = value.lower()
        lower, upper, digit = sum(map(str.islower, value)), sum(map(str.isupper, value)), sum(map(str.isdigit, value))
        kind = ["d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "s" for c in value]
        counts: dict[str, int] = {}
        for c in value:
            counts[c] = counts.get(c, 0) + 1
        entropy = -sum(v / n * math.log2(v / n) for v in counts.values())
        letters = [p for p in zip(low, low[1:], strict=False) if p[0].isalpha() and p[1].isalpha()]
        usual = sum(self.pairs.get(a + b, -9.0) for a, b in letters) / len(letters) if letters else -9.0
        covered = sum(len(m) for m in self.words.findall(low)) / n
        near = [w.lower() for w in self.split(before)[-3:]]
        last = near[-1] if near else ""
        parts = set(re.split("[_-]", last)) | {last}
        tail = before.rstrip()
        quote = before[-1:] in "\"'`" and before[-1:] != ""
        assigned = bool(re.search(r"[=:]\s*[\"'`]?$", before))
        hexa = all(c in "0123456789abcdef" for c in low)
        longest = max(len(m) for m in re.findall(r"[A-Za-z]*", value))
        return [float(x) for x in (
            n, lower / n, upper / n, digit / n, value.count(".") / n, (n - lower - upper - digit) / n, sum(a != b for a, b in zip(kind, kind[1:], strict=False)) / n,
            entropy, len(counts) / n, usual, covered, longest / n, hexa, digit == n, digit == 0, hexa and n in (32, 40, 64, 128),
            low.count("/"), "://" in before[-8:] or tail.endswith(("/", "\\")), bool(re.search(r"\.[a-z]{2,4}$", low)), "@" in before[-40:].rpartition(" ")[2] or after[:1] == "@",
            quote, assigned, bool(parts & self.names), any(set(re.split("[_-]", w)) & self.names or w in self.names for w in near),
            bool(parts & self.harmless), any(w in self.harmless for w in near), low.count("-") == 4 and n == 36, PUBLISHED.match(value) is not None)]


def _rule(value: str, f: list[float]) -> float | None:
    """1 for a random value assigned to a credential's name, 0 for what is clearly no secret, None where the rules don't decide."""
    if PUBLISHED.search(value):
        return None
    if f[21] and f[22]:
        random_like = f[7] >= min(2.8, 0.85 * math.log2(len(value))) and f[10] < 0.5 and (f[3] > 0.1 or f[6] > 0.2)
        return 1.0 if random_like and not f[24] and not CODE.search(value) else None
    words = f[10] >= 0.5 or (f[3] <= 0.1 and f[6] <= 0.35 and f[9] > -7)
    harmless = f[24] and (f[12] or f[26])
    return 0.0 if words or f[13] or harmless or f[7] < 2 else None


def scan(docs: DataFrame) -> DataFrame:
    """Every candidate: doc_id, hash of the text, first and last (characters), value, weak label and features."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measures = Measures()
        kind = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("value", pa.string()), ("weak", pa.float64()), ("features", pa.list_(pa.float64()))])
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_pylist(_found(part, measures), kind)

    texts = fit(docs, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text"))
    return texts.mapInArrow(run, "doc_id long, text_hash long, first long, last long, value string, weak double, features array<double>")


def _found(part: pa.RecordBatch, measures: Measures) -> list[dict]:
    data, off = utf8(part.column("text"))
    # characters before a byte, from the bytes that begin one
    upto = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    ids, keys, out = part.column("doc_id"), part.column("text_hash"), []
    for r, a, b in candidates(part.column("text")):
        lo, hi = int(off[r]), int(off[r + 1])
        value = data[lo + a : lo + b].tobytes().decode()
        before = data[max(lo, lo + a - CONTEXT) : lo + a].tobytes().decode(errors="ignore")
        after = data[lo + b : min(hi, lo + b + CONTEXT)].tobytes().decode(errors="ignore")
        f = measures.of(value, before, after)
        first = int(upto[lo + a] - upto[lo])
        out.append({"doc_id": ids[r].as_py(), "text_hash": keys[r].as_py(), "first": first, "last": first + len(value) - 1, "value": value, "weak": _rule(value, f), "features": f})
    return out


def _examples() -> list[tuple[str, str, float]]:
    """(text before, value, label) for published formats of credentials and their look-alikes."""
    draw = random.Random(SEED)
    some = lambda letters, n: "".join(draw.choice(letters) for _ in range(n))
    hexa, digits = "0123456789abcdef", "0123456789"
    small, big = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    base = small + big + digits
    secret = [lambda: some(hexa, 40), lambda: some(hexa, 32), lambda: some(hexa, 64), lambda: some(hexa.upper(), 40), lambda: some(base, 24), lambda: some(base, 40), lambda: some(base + "+/", 44),
              lambda: "AKIA" + some(big + digits, 16), lambda: "ghp_" + some(base, 36), lambda: "glpat-" + some(base + "_-", 20), lambda: "xoxb-" + some(digits, 12) + "-" + some(base, 24),
              lambda: "sk_live_" + some(base, 24), lambda: "sk-" + some(base, 48), lambda: "AIza" + some(base + "_-", 35), lambda: "npm_" + some(base, 36),
              lambda: "eyJhbGciOiJIUzI1NiJ9." + some(base, 40) + "." + some(base + "_-", 43), lambda: "SG." + some(base, 22) + "." + some(base, 43), lambda: some(base + "_-", 14)]
    words = [w for w in WORDS if len(w) > 3]
    # what people type: 8 to 13 characters with a digit and a capital, half of them with other signs
    def typed(letters: str) -> str:
        value = list(some(letters, draw.randint(5, 10)) + some(digits, 2) + some(big, 1))
        draw.shuffle(value)
        return "".join(value)

    odd = base + "!@#$%&*?^~+=_-."
    short = [lambda: typed(base), lambda: typed(base), lambda: typed(odd), lambda: typed(odd), lambda: some(odd, 16)]
    code = [lambda: draw.choice(words) + "." + draw.choice(words) + "()", lambda: "${" + draw.choice(words).upper() + "_" + draw.choice(NAMES).upper() + "}", lambda: "<your-" + draw.choice(words) + ">",
            lambda: "{{" + draw.choice(words) + "}}", lambda: "*" * draw.randint(8, 12), lambda: "get" + draw.choice(words).capitalize() + "(" + draw.choice(words) + ")", lambda: some(digits, 8),
            lambda: "2024-" + some("01", 2) + "-" + some(digits, 2), lambda: draw.choice(words) + draw.choice(words), lambda: draw.choice(words) + "[" + some(digits, 1) + "]." + draw.choice(words),
            lambda: "//" + draw.choice(words) + ".example.com/" + draw.choice(words) + "?" + draw.choice(words) + "=" + some(digits, 2), lambda: draw.choice(words) + "," + draw.choice(words) + ";",
            lambda: some(digits, 1) + "." + some(digits, 2) + "." + some(digits, 1) + "-" + draw.choice(words), lambda: some(digits, 2) + ":" + some(digits, 2) + ":" + some(digits, 2), lambda: draw.choice(words).capitalize() + "!" + draw.choice(words)]
    plain = [lambda: some(digits, 16), lambda: some(digits, 13), lambda: "".join(draw.sample(words, 4)), lambda: "".join(w.capitalize() for w in draw.sample(words, 3)), lambda: "_".join(draw.sample(words, 3)),
             lambda: "/".join(draw.sample(words, 4)), lambda: "/" + "/".join(draw.sample(words, 3)) + ".txt", lambda: "mail" + some(digits, 1) + ".example.com", lambda: ".".join(draw.sample(words, 3)),
             lambda: ".".join(some(digits, 3) for _ in range(4)), lambda: "-".join(draw.sample(words, 4)), lambda: "".join(some(small, draw.choice((2, 3))) for _ in range(6)),
             lambda: "".join(some(big, draw.choice((2, 3))) for _ in range(6)), lambda: draw.choice(words).upper() * 3, lambda: "=" * 20, lambda: "-" * 24, lambda: "your_" + "_".join(draw.sample(words, 2)) + "_here",
             lambda: "x" * 20, lambda: "2024-01-" + some(digits, 2) + "T00.00.00"]
    marks = ['{} = "', "{}: ", '{}="', "{}=", "{} ", "{} is '", '"{}": "']
    signed = [m for m in marks if "=" in m or ":" in m]
    out = []
    for name in NAMES:
        for make in secret:
            out.append((f"{draw.choice(words)} {draw.choice(marks).format(draw.choice((name, name.upper())))}", make(), 1.0))
        for make in plain:
            out.append((f"{draw.choice(words)} {draw.choice(marks).format(name)}", make(), 0.0))
        for make in short:
            out.append((f"{draw.choice(words)} {draw.choice(signed).format(draw.choice((name, name.upper())))}", make(), 1.0))
        for make in code:
            out.append((f"{draw.choice(words)} {draw.choice(signed).format(name)}", make(), 0.0))
    shaped = [f for f in secret if not f().isalnum()] + [secret[7]]
    for name in [*HARMLESS, *words[:60]]:
        for make in (lambda: some(hexa, 40), lambda: some(hexa, 32), lambda: some(hexa, 64), lambda: "-".join(some(hexa, n) for n in (8, 4, 4, 4, 12))) if name in HARMLESS else ():
            out.append((f"{draw.choice(words)} {draw.choice(marks).format(name)}", make(), 0.0))
        for make in plain:
            out.append((f"{draw.choice(words)} {draw.choice((name, *[m.format(name) for m in marks]))}", make(), 0.0))
        for make in code:
            out.append((f"{draw.choice(words)} {draw.choice(signed).format(name)}", make(), 0.0))
        out.append((f"{draw.choice(words)} {name} ", draw.choice(shaped)(), 1.0))
    # bare values in prose, logs and addresses
    bare = ["{0} {1} ", "2024-01-02 03:04:05 INFO {0} {1} ", "{0} ({1}) ", "https://{0}.example.com/{1}?k=", "{0}, {1}, ", "{0} {1}: ", "{0} {1} \"", ""]
    for _ in range(6):
        for before in bare:
            for make, label in [*((f, 1.0) for f in shaped), *((f, 0.0) for f in plain)]:
                out.append((before.format(*draw.sample(words, 2)), make(), label))
    # an address is no credential as a whole: what its parameters hold is a candidate of its own
    for before in ("{} https:", "{} ", "{} url = \"", "{} href=", "{}: "):
        for make in [*secret, *short]:
            for _ in range(4):
                address = f"//{draw.choice(words)}.example.com/{draw.choice(words)}?{draw.choice((draw.choice(words), *NAMES, 'k'))}={make()}"
                out.append((before.format(draw.choice(words)), address if before.endswith("https:") else "https:" + address, 0.0))
    return out


def labelled_findings(spark: SparkSession, docs: DataFrame | None = None, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """features and label of training findings: examples of formats, and candidates that the rules label in a sample of about `sample_docs` distinct documents at most."""
    measures, rows = Measures(), []
    for before, value, label in _examples():
        rows.append((measures.of(value, before, '"' if before.endswith('"') else " "), label))
    out = spark.createDataFrame(rows, "features array<double>, label double")
    if docs is None:
        return out
    every = max(1, -(-docs.count() // sample_docs))
    # repeated rows count once, however many share an id or a text; sorted, so that the forest is the same in each run
    some = fit(docs, doc_id="long", text="string").withColumn("pick", F.xxhash64("doc_id", "text", F.lit("sample")))
    some = some.filter(F.pmod("pick", F.lit(every)) == 0).dropDuplicates(["pick"]).sortWithinPartitions("pick")
    return out.unionByName(scan(some).filter("weak is not null").select("features", F.col("weak").alias("label")))


def train(findings: DataFrame) -> RandomForestClassificationModel:
    """A random forest over labelled findings (features, label)."""
    rows = findings.select(array_to_vector("features").alias("features"), "label").cache()
    try:
        return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxMemoryInMB=64, featureSubsetStrategy="onethird").fit(rows)
    finally:
        rows.unpersist()


def _outermost(found: DataFrame) -> DataFrame:
    """Findings that lie in no other one of their text; repeated rows of a text keep theirs each."""
    text = ("doc_id", "text_hash")
    each = found.groupBy(*text, "first", "last", "value").agg(F.max("probability").alias("probability"), F.count(F.lit(1)).alias("times"))
    before = Window.partitionBy(*text).orderBy("first", F.col("last").desc()).rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("covered", F.coalesce(F.max("last").over(before), F.lit(-1))).filter(F.col("first") > F.col("covered"))
    return each.withColumn("times", F.explode(F.expr("array_repeat(0, cast(times as int))"))).drop("times", "covered")


def _findings(docs: DataFrame, model: RandomForestClassificationModel, least: float) -> DataFrame:
    scored = model.transform(scan(docs).withColumn("features", array_to_vector("features")))
    return _outermost(scored.withColumn("probability", F.element_at(vector_to_array("probability"), 2)).filter(F.col("probability") >= least))


def secrets(docs: DataFrame, model: RandomForestClassificationModel, least: float = 0.5) -> DataFrame:
    """doc_id, first, last, value and probability of the findings that the forest keeps."""
    return _findings(docs, model, least).select("doc_id", "first", "last", "value", "probability")


def redact(docs: DataFrame, model: RandomForestClassificationModel) -> DataFrame:
    """`docs`, all columns, with every secret replaced by `MASK` and n_chars, if there, adjusted.

    Findings are grouped by doc_id and hash of the text, so a group holds those of one text,
    however many rows share an id.  Null texts stay as they are.
    """
    span, own_id, own_hash, own_spans = F.struct("first", "last", "value"), spare(docs, "found_id"), spare(docs, "found_hash"), spare(docs, "found_spans")
    found = _findings(docs, model, 0.5).groupBy(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash)).agg(F.collect_set(span).alias(own_spans))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64(docs["text"].cast("string")) == F.col(own_hash)) & docs["text"].isNotNull()
    both = docs.join(found, same, "left").drop(own_id, own_hash)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, names = batch.column(own_spans), batch.schema.names
            hit = [i for i in range(batch.num_rows) if spans[i].is_valid]
            columns = {c: batch.column(c) for c in names if c != own_spans}
            if hit:
                texts = columns["text"].to_pylist()
                size = columns["n_chars"].to_pylist() if "n_chars" in columns else None
                for i in hit:
                    for s in sorted(spans[i].as_py(), key=lambda s: -s["first"]):
                        if texts[i][s["first"] : s["last"] + 1] == s["value"]:
                            texts[i] = texts[i][: s["first"]] + MASK + texts[i][s["last"] + 1 :]
                    if size:
                        size[i] = len(texts[i])
                columns["text"] = pa.array(texts, columns["text"].type)
                if size:
                    columns["n_chars"] = pa.array(size, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return both.mapInArrow(run, docs.schema)
