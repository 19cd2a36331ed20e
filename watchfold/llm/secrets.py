"""Secrets in texts: fixed forms, and long tokens that a battery of randomness tests takes for keys.

Everything is DataFrame functions. A row's spans are worked out inside the row: the
matches of a form and the pieces between them give the places, so nothing is shuffled.
Only the histogram of test scores is gathered: a row per band of lengths and score step,
of which there are a fixed number.

The battery: a token's alphabet is inferred (hex, base32, lower-case base36, base64).
Three tests ask whether it looks like written language in that alphabet (the null
hypothesis) rather than like uniform random characters:

* chi-squared of the character counts against uniformity. Language is at least
  ``TEXT_SHARE`` of the divergence that English letters have, per character, so the
  statistic's distance from uniform grows with the length.
* runs: how often the class of character (upper, lower, digit, sign) changes; language
  changes at most half as often as random characters.
* serial correlation of neighbouring characters' places in the alphabet; language has
  at least ``TEXT_CORRELATION``.

Their z scores are added and divided by the root of three. Tokens are taken by the
procedure of Benjamini and Hochberg at the false-discovery rate ``FDR``, apart for each
band of lengths, so that many short and doubtful tokens do not weaken the long ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold.llm.common import col, own_name
from watchfold.session import keep

# The forms of the base spans.
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "random")

TOKEN = r"[A-Za-z0-9+/_-]{16,}"
FDR = 0.01
BANDS = (16, 24, 32, 48, 96)
STEPS = 16  # steps of a unit of z in the histogram
TEXT_SHARE = 0.5
TEXT_CORRELATION = 0.3
ENGLISH = 0.066  # chance that two letters of an English text are equal

UPPER, LOWER, DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Name: characters of a token of that encoding, alphabet.
ENCODINGS = {
    "hex": (r"^(?:[0-9a-f]+|[0-9A-F]+)$", DIGIT + "abcdef"),
    "base32": (r"^[A-Z2-7]+$", UPPER + "234567"),
    "base36": (r"^[a-z0-9]+$", LOWER + DIGIT),
    "base64": (r"", UPPER + LOWER + DIGIT + "+/"),
}
#: A token that could be an encoding at all: a digit, or an upper case letter after another character's case.
MIXED = r"[0-9]|[a-z][^a-z]*[A-Z]"


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def before(values: Column) -> Column:
    """For each place of an array of longs the sum before it, in chunks of about the root of its size."""
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values))).cast("int"))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(values) - 1), width)
    sums = F.transform(starts, lambda s: total(F.slice(values, s + 1, width)))

    def chunk(s: Column, k: Column) -> Column:
        own = F.slice(values, s + 1, width)
        base = total(F.slice(sums, F.lit(1), k))
        return F.transform(own, lambda _, i: base + total(F.slice(own, F.lit(1), i)))

    return F.flatten(F.transform(starts, chunk))


def matches(df: DataFrame, text: str, found: str, pattern: str) -> DataFrame:
    """Column ``found``: array of (start, len, word) of the pattern's matches, in code points."""
    df = df.withColumn("_m", F.regexp_extract_all(col(text), F.lit(pattern), F.lit(0)))
    gaps = F.transform(F.split(col(text), pattern, -1), lambda p: F.length(p).cast("long"))
    df = df.withColumn("_gap", F.when(F.size("_m") > 0, gaps))
    df = df.withColumn("_step", F.zip_with("_m", F.slice("_gap", F.lit(2), F.size("_m")), lambda m, g: F.length(m) + g))
    df = df.withColumn("_before", F.when(F.size("_m") > 0, before(F.col("_step"))))
    spans = F.zip_with(
        "_m",
        "_before",
        lambda m, b: F.struct((F.col("_gap")[0] + b).alias("start"), F.length(m).cast("long").alias("len"), m.alias("word")),
    )
    none = F.array().cast("array<struct<start:bigint,len:bigint,word:string>>")
    return df.withColumn(found, F.when(F.size("_m") > 0, spans).otherwise(none)).drop("_m", "_gap", "_step", "_before")


def as_spans(found: Column, kind: str) -> Column:
    return F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (s["start"] + s["len"]).alias("end")
        ),
    )


def base_spans(df: DataFrame, text: str, name: str) -> DataFrame:
    """Column ``name``: array of (start, kind number, end) of the fixed forms, sorted."""
    df = matches(df, text, "_assign", ASSIGN)
    # The value is what follows the last quote, blank, colon or equals sign that the pattern's first half takes.
    value = lambda m: F.regexp_extract(m, ASSIGN, 1)
    df = df.withColumn("_assign", F.filter("_assign", lambda s: F.length(value(s["word"])) >= LEAST["assign"]))
    # Runs of one class: a run that is too short holds no longer match, so the length can be in the pattern.
    df = matches(df, text, "_access", ACCESS[:-1] + "{%d,}" % (LEAST["access"] - 4))
    df = matches(df, text, "_hex", HEX[:-1] + "{%d,}" % LEAST["hex"])
    spans = F.concat(*[as_spans(F.col(f"_{k}"), k) for k in KINDS[:3]])
    return df.withColumn(name, F.array_sort(spans)).drop("_assign", "_access", "_hex")


def places(chars: Column, alphabet: str) -> Column:
    return F.transform(chars, lambda c: F.instr(F.lit(alphabet), c).cast("double"))


def z_score(word: Column) -> Column:
    """Sum of the battery's z scores over the root of three; the lower, the less like language."""
    out = None
    for pattern, alphabet in reversed(ENCODINGS.values()):
        size = len(alphabet)
        plain = F.lower(word) if size == 16 else F.translate(word, "-_", "+/")
        n = F.length(plain).cast("double")
        chars = F.filter(F.split(plain, ""), lambda c: c != "")
        counts = F.transform(
            F.array_distinct(chars), lambda c: F.length(plain) - F.length(F.replace(plain, c, F.lit("")))
        )
        squares = F.aggregate(counts, F.lit(0).cast("double"), lambda a, k: a + k * k)
        far = TEXT_SHARE * max(ENGLISH * size - 1, 0.3)
        chi = (squares * size / n - n - (size - 1) - n * far) / F.sqrt(F.lit(2.0 * (size - 1)) + n * 4 * far)
        share = [sum(c in s for c in alphabet) / size for s in (UPPER, LOWER, DIGIT, "+/")]
        turn = (1 - sum(s * s for s in share)) / 2
        classes = F.translate(plain, UPPER + LOWER + DIGIT, "U" * 26 + "L" * 26 + "D" * 10)
        runs = F.length(F.regexp_replace(classes, r"(.)\1+", "$1")).cast("double")
        run = -(runs - 1 - (n - 1) * turn) / F.sqrt((n - 1) * turn * (1 - turn))
        at = places(chars, alphabet)
        sums = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
        mean = sums(at) / n
        spread = sums(F.transform(at, lambda x: (x - mean) * (x - mean)))
        pairs = F.zip_with(
            F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, F.lit(2), F.size(at) - 1), lambda x, y: (x - mean) * (y - mean)
        )
        along = F.when(spread > 0, sums(pairs) / spread).otherwise(1.0)
        serial = (along - TEXT_CORRELATION) * F.sqrt(n)
        z = (chi + run + serial) / 3**0.5
        out = z if out is None else F.when(word.rlike(pattern), z).otherwise(out)
    return out


def lower_tail(z: Column) -> Column:
    """Normal distribution function at or below 0: a rational bound near 0, the asymptotic series far out."""
    a = -z
    density = F.exp(-a * a / 2) / F.lit((2 * 3.141592653589793) ** 0.5)
    t = 1 / (1 + 0.2316419 * a)
    near = density * t * (
        0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))
    )
    far = density / a * (1 - 1 / (a * a) + 3 / (a * a * a * a))
    return F.when(z >= 0, F.lit(1.0)).when(z > -5, near).otherwise(far)


def band_of(length: Column) -> Column:
    out = F.lit(0)
    for i, b in enumerate(BANDS[1:], 1):
        out = F.when(length >= b, i).otherwise(out)
    return out


def with_candidates(df: DataFrame, text: str, base: str, name: str) -> DataFrame:
    """Column ``name``: array of (start, end, band, step) of tokens for the battery.

    A token inside a span of ``base`` is known. One that a span overlaps in part is tested
    whole, and so are its pieces outside the spans that are long enough for a token.
    """
    df = matches(df, text, "_token", TOKEN)

    def parts(t: Column) -> Column:
        end = t["start"] + t["len"]
        hits = F.filter(base, lambda b: (b["start"] < end) & (b["end"] > t["start"]))
        whole = F.struct(t["start"].alias("start"), t["len"].alias("len"), t["word"].alias("word"))
        # A gap ends where a span starts, or with the token, and starts where the spans before it end.
        edge = F.array_append(F.transform(hits, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))), F.struct(end.alias("start"), end.alias("end")))
        none = F.array().cast("array<struct<start:bigint,len:bigint,word:string>>")

        def step(acc: Column, b: Column) -> Column:
            size = b["start"] - acc["at"]
            word = F.substring(t["word"], (acc["at"] - t["start"] + 1).cast("int"), size.cast("int"))
            piece = F.struct(acc["at"].alias("start"), size.alias("len"), word.alias("word"))
            pieces = F.when(size >= BANDS[0], F.array_append(acc["pieces"], piece)).otherwise(acc["pieces"])
            return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), pieces.alias("pieces"))

        start = F.struct(t["start"].alias("at"), none.alias("pieces"))
        pieces = F.aggregate(edge, start, step, lambda acc: acc["pieces"])
        inside = F.exists(hits, lambda b: (b["start"] <= t["start"]) & (b["end"] >= end))
        return F.when(F.size(hits) == 0, F.array(whole)).when(inside, none).otherwise(F.concat(F.array(whole), pieces))

    df = df.withColumn("_token", F.flatten(F.transform("_token", parts)))
    df = df.withColumn("_token", F.filter("_token", lambda t: t["word"].rlike(MIXED)))
    scored = F.transform(
        "_token",
        lambda t: F.struct(
            t["start"].alias("start"),
            (t["start"] + t["len"]).alias("end"),
            band_of(t["len"]).alias("band"),
            F.greatest(F.lit(-40 * STEPS), F.least(F.lit(0), F.ceil(z_score(t["word"]) * STEPS))).cast("int").alias("step"),
        ),
    )
    return df.withColumn(name, scored).drop("_token")


def cuts(df: DataFrame, candidates: str) -> list[int]:
    """For each band of lengths the highest step whose tokens are taken; none: below all steps.

    Benjamini and Hochberg on the histogram, each token at the upper edge of its step.
    """
    steps = df.select(F.explode(col(candidates)).alias("c")).groupBy("c.band", "c.step").count()
    by = Window.partitionBy("band")
    ranked = steps.withColumns({"below": F.sum("count").over(by.orderBy("step")), "all": F.sum("count").over(by)})
    fine = ranked.where(lower_tail(F.col("step") / STEPS) <= FDR * F.col("below") / F.col("all"))
    best = {r["band"]: r["cut"] for r in fine.groupBy("band").agg(F.max("step").alias("cut")).collect()}
    return [best.get(b, -100 * STEPS) for b in range(len(BANDS))]


def with_spans(df: DataFrame, text: str, base: str, name: str) -> DataFrame:
    """``df``, stored, with arrays (start, kind number, end) ``base`` (fixed forms) and ``name`` (all)."""
    tokens = own_name(df, "tokens")
    df = df.withColumn(text, F.coalesce(col(text), F.lit("")))
    found = keep(with_candidates(base_spans(df, text, base), text, base, tokens), "secret-candidates")
    cut = F.array(*[F.lit(c) for c in cuts(found, tokens)])
    taken = F.filter(tokens, lambda t: t["step"] <= F.element_at(cut, t["band"] + 1))
    random = F.transform(
        taken, lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), t["end"].alias("end"))
    )
    return found.withColumn(name, F.array_sort(F.concat(base, random))).drop(tokens)


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its id, counts of the fixed forms, digest of their spans and all ``spans``.

    A null text is empty and has no span; repeated rows give equal rows; an empty table
    an empty result. Places are code points, ends exclusive. A text of any length is
    searched whole; tokens of equal scores are taken together or not at all. Further
    columns play no part.
    """
    rows = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    found = with_spans(rows, "text", "base", "all")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("all")).alias("spans"),
        (F.size("all") - F.size("base")).cast("long").alias("n_random"),
    )


def hide_secrets(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with each stretch of overlapping or touching spans in ``text`` replaced by ``mark``; null stays null.

    The other columns, whatever their names and types, come along in a struct.
    """
    others = [col(c) for c in docs.columns if c != text]
    rest = F.struct(*others) if others else F.lit(None)
    row = F.struct(col(text).isNull().alias("no text"), rest.alias("others"))
    found = with_spans(docs.select(row.alias("row"), col(text).alias("text")), "text", "base", "spans")
    start = F.struct(
        F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("pieces")
    )

    def step(acc: Column, s: Column) -> Column:
        piece = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        joined = (s["start"] <= acc["at"]) & (acc["at"] > 0)
        pieces = F.when(joined, acc["pieces"]).otherwise(F.array_append(acc["pieces"], piece))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), pieces.alias("pieces"))

    def end(acc: Column) -> Column:
        rest = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text"))
        return F.array_join(F.array_append(acc["pieces"], rest), mark)

    hidden = F.when(F.size("spans") > 0, F.aggregate(F.col("spans"), start, step, end)).otherwise(F.col("text"))
    hidden = F.when(~F.col("row")["no text"], hidden)
    return found.select(*[(hidden if c == text else F.col("row")["others"][c]).alias(c) for c in docs.columns])
