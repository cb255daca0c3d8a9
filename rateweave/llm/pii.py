"""Personal data by weak supervision, in SQL functions alone.

Strict patterns are reported wherever they match. Looser patterns give candidates
on which three labelers vote: the form of the match, a gazetteer, and the words in
front of it. The gazetteer is a table that the candidates are joined with: public
codes, what the strict spans of the corpus itself show (names in mail addresses,
area codes of full numbers), and any table the caller adds. Expectation-maximisation
over the votes of all candidates estimates how reliable each labeler is. Its
posteriors train a logistic classifier on what no labeler looks at: the characters
around a span, how it is written, and whether a strict span is near. Votes and
classifier together decide on the looser candidates.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.functions.once import computed_once
from rateweave.llm.tables import keep

KINDS = ("email", "ip", "card", "phone", "local_phone", "national_id", "iban", "birth_date", "person")
BASE = 4
LEAST_SCORE, LEAST_VOTES = 0.9, 1
CONTEXT = 40
# A strict span so many code points away is near.
NEAR = 100
# Candidates that the first guess of a labeler's rates counts for.
PRIOR_VOTES = 50
# Rows that must show a name or an area code before the gazetteer has it.
LEAST_SEEN = 3
BLOCK = 64
# Stands for a dot that belongs to no domain name while mail addresses are searched.
NO_DOT = "\x01"

# The strict patterns, without nested repetition: Java's matcher recurses on it,
# and a long text would exhaust its stack. What the repetition says is first
# written into the text, character by character, so positions stay.
EMAIL = rf"(?:(?<![A-Za-z0-9._%+{NO_DOT}-])|\G)[A-Za-z0-9._%+{NO_DOT}-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"
LOOSE_DOT = r"\.(?![A-Za-z0-9-])|(?<![A-Za-z0-9-])\."
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9][0-9\x20-]*+"
LOOSE_GAP = r"[\x20-](?![0-9])|(?<![0-9])[\x20-]"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

LOCAL_PHONE = r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
NATIONAL_ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IBAN = r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b"
BIRTH_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
PERSON = r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Monsieur|Madame|Señor|Señora)\b\.?\x20\p{Lu}\p{Ll}{1,20}"
WEAK = "|".join((LOCAL_PHONE, NATIONAL_ID, IBAN, BIRTH_DATE, PERSON))
# Which weak kind a match is; the first that fits.
WEAK_KIND = (
    (r"^\p{Lu}\p{Ll}", 8), (r"^[A-Z]{2}[0-9]{2}", 6), (r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$", 5),
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", 7),
)

PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
GOOD_IP = rf"^{PART}\.{PART}\.{PART}\.{PART}$"

# Per kind: the form that counts as a vote, and words in front.
FORM = (
    r"@", r"^[1-9]", r"^[3-6]", r"^\+[1-9]", r"^\(?[2-9]", r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
    r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$", r"-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])$", r"\x20\p{Lu}\p{Ll}{2,}",
)
# Public codes per kind, by which :func:`_keys` looks candidates up.
CODES = {
    0: "com org net edu gov info io de fr es it nl uk eu",
    1: "10 127 172 192 8",
    2: "4 51 52 53 54 55 34 37 6011 65",
    3: "1 33 34 39 41 43 44 49",
    4: "800 888 877 212 415 617 -555",
    6: "AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE",
    8: "anna james john maria marie mary michael peter robert schmidt smith thomas garcia martin muller",
}
NATIONAL_AREAS, BIRTH_YEARS = (1, 772), (1900, 2019)
CONTEXT_WORDS = (
    r"mail|contact|write", r"\bip\b|address|host|server", r"card|visa|payment|credit|karte|carte",
    r"phone|tel\b|call|fax|mobile", r"phone|tel\b|call|fax|mobile", r"ssn|social|national id|id no",
    r"iban|account|konto|compte|cuenta", r"born|birth|dob|geboren|naissance|nacim", r"contact|name|dear|patient|client",
)


# Classes of a character beside a span; the first that fits, else the number after
# the last. Loose dots and gaps may stand as the marks that a search put there.
BESIDE = (r"^$", r"[:=#]", r"[.,;!?\x01]", r"[\x20\x09-\x0D_]", r"[A-Za-z0-9]")
# How a span is written: by the first character that is neither letter nor digit.
WRITTEN = (r"^[\p{L}0-9]*$", r"^[\p{L}0-9]*[\x20_]", r"^[\p{L}0-9]*-", r"^[\p{L}0-9]*\.")
TRAITS = ("lead", "front", "tail", "written", "near")


class Vote(NamedTuple):
    """A pattern of votes and how many candidates have it."""

    kind: int
    votes: tuple[int, ...]
    n: int


def _marked(text: Column, name: str) -> Column:
    """The text to search for a kind, as long as the original."""
    if name == "email":
        return F.regexp_replace(F.translate(text, NO_DOT, " "), F.lit(LOOSE_DOT), F.lit(NO_DOT))
    if name == "card":
        return F.regexp_replace(text, F.lit(LOOSE_GAP), F.lit("_"))
    return text


SEARCHES = {
    "email": (EMAIL, lambda t: t.contains("@")),
    "ip": (IP, lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")),
    "card": (CARD, lambda t: t.rlike(r"[0-9][0-9\x20-]{10,}[0-9]")),
    "phone": (PHONE, lambda t: t.contains("+")),
    "weak": (WEAK, lambda t: t.rlike(WEAK)),
}


def _with_matches(docs: DataFrame) -> DataFrame:
    """``<name>_hits`` and ``<name>_gaps`` of each search: the matches, the text between."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = computed_once(docs, F.col("doc_id"), text.alias("t"))
    marked = []
    for name, (_, some) in SEARCHES.items():
        marked.append(F.when(some(F.col("t")), _marked(F.col("t"), name)).alias(name))
    searched = computed_once(plain, F.col("doc_id"), *marked)
    found = []
    for name, (pattern, _) in SEARCHES.items():
        own = F.col(name)
        found.append(F.regexp_extract_all(own, F.lit(pattern), F.lit(0)).alias(f"{name}_hits"))
        found.append(F.split(own, pattern, -1).alias(f"{name}_gaps"))
    return computed_once(searched, F.col("doc_id"), *found)


def _total(part: Column) -> Column:
    return F.aggregate(part, F.lit(0), lambda a, x: a + x)


def _step(hits: Column):
    return lambda gap, i: F.length(gap) + F.coalesce(F.length(F.get(hits, i - 1)), F.lit(0))


def _block_sum(steps: Column):
    return lambda b: _total(F.slice(steps, b * BLOCK + 1, BLOCK))


def _sum_before(sums: Column):
    return lambda x, i: _total(F.slice(sums, 1, i))


def _span(gaps: Column, steps: Column, before: Column):
    def one(hit: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        start = F.get(before, block) + _total(F.slice(steps, block * BLOCK + 1, i - block * BLOCK + 1))
        return F.struct(
            start.cast("int").alias("start"), (start + F.length(hit)).cast("int").alias("stop"),
            hit.alias("hit"), F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get(gaps, i + 1), F.lit(1)).alias("behind"),
        )

    return one


def _with_starts(found: DataFrame) -> DataFrame:
    """``<name>``: array of (start, stop, hit, before, behind) for each search.

    A start is the sum of the lengths before it; sums are kept per block of matches,
    so a text with very many matches does not take the square of their number.
    """
    steps = []
    for name in SEARCHES:
        hits = F.col(f"{name}_hits")
        step = F.transform(f"{name}_gaps", _step(hits))
        steps.append(F.when(F.size(hits) > 0, step).alias(f"{name}_steps"))
    names = [c for n in SEARCHES for c in (f"{n}_hits", f"{n}_gaps")]
    stepped = computed_once(found, "doc_id", *names, *steps)

    sums = []
    for name in SEARCHES:
        own = F.col(f"{name}_steps")
        blocks = F.sequence(F.lit(0), F.floor((F.size(own) - 1) / BLOCK).cast("int"))
        sums.append(
            F.when(
                own.isNotNull(),
                F.transform(blocks, _block_sum(own)),
            ).alias(f"{name}_sums")
        )
    names += [f"{n}_steps" for n in SEARCHES]
    summed = computed_once(stepped, "doc_id", *names, *sums)
    before = []
    for name in SEARCHES:
        own = F.col(f"{name}_sums")
        before.append(F.transform(own, _sum_before(own)).alias(f"{name}_before"))
    placed = computed_once(summed, "doc_id", *names, *before)
    out = []
    for name in SEARCHES:
        spans = F.transform(f"{name}_hits", _span(*(F.col(f"{name}_{x}") for x in ("gaps", "steps", "before"))))
        out.append(spans.alias(name))
    return computed_once(placed, "doc_id", *out)


def _pick(kind: Column, patterns: tuple[str, ...], text: Column) -> Column:
    out = F.lit(False)
    for i, pattern in enumerate(patterns):
        out = F.when(kind == i, text.rlike(pattern)).otherwise(out)
    return out


def _first_class(text: Column, patterns: tuple[str, ...]) -> Column:
    """Number of the first pattern found in a text; one more than the last if none is."""
    out = F.lit(len(patterns))
    for i, pattern in reversed(list(enumerate(patterns))):
        out = F.when(text.rlike(pattern), F.lit(i)).otherwise(out)
    return out


def _keys(kind: Column, hit: Column) -> Column:
    """Entries of the gazetteer that would speak for a candidate."""
    digits = F.regexp_replace(hit, F.lit("[^0-9]"), F.lit(""))
    starts = lambda *sizes: F.array(*[F.left(digits, F.lit(n)) for n in sizes])
    keys = (
        F.array(F.lower(F.substring_index(hit, ".", -1))), F.array(F.substring_index(hit, ".", 1)),
        starts(1, 2, 4), starts(1, 2, 3), F.array(F.left(digits, F.lit(3)), F.concat(F.lit("-"), F.substring(digits, 4, 3))),
        starts(3), F.array(F.left(hit, F.lit(2))), starts(4), F.array(F.lower(F.substring_index(hit, " ", -1))),
    )
    out = F.array().cast("array<string>")
    for i, own in enumerate(keys):
        out = F.when(kind == i, own).otherwise(out)
    return F.array_distinct(out)


def _shows(kind: Column, hit: Column) -> Column:
    """What a strict span adds to the gazetteer: names of a mail address, the area code of a number."""
    names = F.filter(F.split(F.lower(F.substring_index(hit, "@", 1)), "[^a-z]+"), lambda x: F.length(x) >= 3)
    digits = F.regexp_replace(hit, F.lit("[^0-9]"), F.lit(""))
    area = F.when(digits.rlike("^1[0-9]{10}$"), F.array(F.substring(digits, 2, 3)))
    return F.when(kind == 0, F.array_distinct(names)).when(kind == 3, area)


def _candidate(kind: Column, x: Column) -> Column:
    ahead = F.rtrim(F.regexp_replace(x.before, F.lit(r"[\x09-\x0D_]"), F.lit(" ")))
    return F.struct(
        x.start.alias("start"), kind.cast("int").alias("kind"), x.stop.alias("stop"),
        _pick(kind, FORM, x.hit).cast("int").alias("v0"),
        _pick(kind, CONTEXT_WORDS, F.lower(x.before)).cast("int").alias("v2"),
        _keys(kind, x.hit).alias("keys"),
        F.when(kind < BASE, _shows(kind, x.hit)).alias("shows"),
        _first_class(F.right(ahead, F.lit(1)), BESIDE).alias("lead"),
        _first_class(F.right(x.before, F.lit(1)), BESIDE).alias("front"),
        _first_class(F.coalesce(x.behind, F.lit("")), BESIDE).alias("tail"),
        _first_class(x.hit, WRITTEN).alias("written"), F.lit(0).alias("near"),
    )


def _as_kind(kind: int):
    return lambda x: _candidate(F.lit(kind), x)


CANDIDATES = (
    "array<struct<start:int,kind:int,stop:int,v0:int,v2:int,keys:array<string>,shows:array<string>,"
    "lead:int,front:int,tail:int,written:int,near:int>>"
)
SPANS = "array<struct<start:int,kind:int,stop:int>>"


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``weak``: candidates with position, kind, votes, keys and traits."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = _with_starts(_with_matches(docs))
    nothing = F.array().cast(CANDIDATES)
    digits = lambda x: F.regexp_replace(x.hit, F.lit("[^0-9]"), F.lit(""))
    checks = {
        "email": lambda x: F.lit(True),
        "ip": lambda x: x.hit.rlike(GOOD_IP),
        "card": lambda x: F.length(digits(x)).between(12, 19) & F.call_function("luhn_check", digits(x)),
        "phone": lambda x: F.length(digits(x)).between(9, 15),
    }
    base = [
        F.coalesce(F.transform(F.filter(name, check), _as_kind(k)), nothing)
        for k, (name, check) in enumerate(checks.items())
    ]

    def weak_kind(x: Column) -> Column:
        out = F.lit(4)
        for pattern, kind in reversed(WEAK_KIND):
            out = F.when(x.hit.rlike(pattern), F.lit(kind)).otherwise(out)
        return out

    weak = F.coalesce(F.transform("weak", lambda x: _candidate(weak_kind(x), x)), nothing)
    both = computed_once(spans, "doc_id", F.array_sort(F.concat(*base)).alias("base"), weak.alias("weak"))
    base_col = F.col("base")
    free = F.filter(
        "weak", lambda w: ~F.exists(base_col, lambda b: (b.start < w.stop) & (w.start < b.stop))
    )
    near = lambda w: F.exists(base_col, lambda b: (b.start < w.stop + NEAR) & (w.start < b.stop + NEAR))
    told = F.transform(free, lambda w: w.withField("near", near(w).cast("int")))
    return both.select("doc_id", "base", told.alias("weak"))


def public_codes(spark: SparkSession) -> DataFrame:
    """The fixed part of the gazetteer: ``kind`` and ``entry``."""
    listed = F.array(*[
        F.struct(F.lit(k).alias("kind"), F.split(F.lit(own), " ").alias("entries")) for k, own in CODES.items()
    ])
    ranges = F.array(*[
        F.struct(
            F.lit(k).alias("kind"),
            F.transform(F.sequence(F.lit(a), F.lit(b)), lambda x, w=w: F.lpad(x.cast("string"), w, "0")).alias("entries"),
        )
        for k, w, (a, b) in ((5, 3, NATIONAL_AREAS), (7, 4, BIRTH_YEARS))
    ])
    one = spark.range(1).select(F.inline(F.concat(listed, ranges)))
    return one.select("kind", F.explode("entries").alias("entry"))


def shown_entries(seen: DataFrame, least_seen: int = LEAST_SEEN) -> DataFrame:
    """What strict spans of ``least_seen`` rows of candidates show: persons and area codes."""
    spans = seen.select("row", F.explode("base").alias("c")).where("c.shows is not null")
    to = F.when(F.col("c.kind") == 0, F.lit(8)).otherwise(F.lit(4))
    entries = spans.select("row", to.alias("kind"), F.explode("c.shows").alias("entry")).distinct()
    return entries.groupBy("kind", "entry").agg(F.count("*").alias("n")).where(F.col("n") >= least_seen).drop("n")


def with_votes(seen: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """A row per candidate of ``seen``: row, kind, start, stop, three votes and the traits.

    The gazetteer, ``kind`` (a number) and ``entry``, may be of any size; a code that
    very many candidates have is split by AQE's skew join.
    """
    entries = gazetteer.select("kind", "entry").distinct().withColumn("listed", F.lit(1))
    spans = seen.select("row", F.explode(F.concat("base", "weak")).alias("c")).select("row", "c.*")
    fixed = ["row", "kind", "start", "stop", "v0", "v2", *TRAITS]
    asked = spans.select(*fixed, F.explode_outer("keys").alias("entry"))
    joined = asked.join(entries, ["kind", "entry"], "left")
    return joined.groupBy(*fixed).agg(F.coalesce(F.max("listed"), F.lit(0)).alias("v1"))


def posteriors(patterns: list[Vote], rounds: int = 50) -> list[float]:
    """Chance that a candidate with each pattern is personal data.

    Expectation-maximisation for labelers that err independently. Each has a rate of
    votes for true and for false candidates, and each kind a share of true ones;
    prior counts hold them in place where there are few candidates.
    """
    labelers = range(len(patterns[0].votes)) if patterns else range(0)
    rate = {(j, t): (0.8 if t else 0.1) for j in labelers for t in (0, 1)}
    share = {p.kind: 0.5 for p in patterns}
    post = [0.5] * len(patterns)
    for _ in range(rounds):
        for i, p in enumerate(patterns):
            chance = [1 - share[p.kind], share[p.kind]]
            for t in (0, 1):
                for j in labelers:
                    chance[t] *= rate[j, t] if p.votes[j] else 1 - rate[j, t]
            post[i] = chance[1] / sum(chance)
        weight = lambda i, t: patterns[i].n * (post[i] if t else 1 - post[i])
        for t in (0, 1):
            for j in labelers:
                yes = sum(weight(i, t) for i, p in enumerate(patterns) if p.votes[j])
                every = sum(weight(i, t) for i in range(len(patterns)))
                rate[j, t] = (yes + PRIOR_VOTES * (0.8 if t else 0.1)) / (every + PRIOR_VOTES)
        for kind in share:
            own = [i for i, p in enumerate(patterns) if p.kind == kind]
            share[kind] = (sum(weight(i, 1) for i in own) + 5) / (sum(patterns[i].n for i in own) + 10)
    return post


class Seen(NamedTuple):
    """Traits of spans of one kind, how many there are and how many of them are true."""

    traits: tuple[int, ...]
    n: float
    true: float


class Classifier(NamedTuple):
    """Of one kind: log odds without traits, and what each (trait, value) adds."""

    always: float
    added: dict[tuple[int, int], float]


class Model(NamedTuple):
    """The classifier of each loose kind, and what each pattern of votes adds to its log odds."""

    classifiers: dict[int, Classifier]
    votes: dict[tuple[int, ...], float]


def log_odds(chance: float) -> float:
    chance = min(max(chance, 1e-6), 1 - 1e-6)
    return math.log(chance / (1 - chance))


def train(
    spans: list[Seen], before: Classifier | None = None, rounds: int = 400, penalty: float = 5.0
) -> Classifier:
    """Logistic regression of one kind on traits, towards shares of true spans.

    ``penalty`` holds the traits' weights near 0 where spans are few, so that the
    votes alone decide there. Starts from ``before`` where that is given.
    """
    total = sum(s.n for s in spans)
    always = log_odds((sum(s.true for s in spans) + 1) / (total + 2))
    added = {(j, v): 0.0 for s in spans for j, v in enumerate(s.traits)}
    if before is not None:
        always, added = before.always, added | before.added
    step = 4.0 / (1 + len(TRAITS) + 4 * penalty / total) if total else 0.0
    for _ in range(rounds):
        slope, by = 0.0, {key: penalty * w / total for key, w in added.items()}
        for s in spans:
            z = always + sum(added[j, v] for j, v in enumerate(s.traits))
            miss = (s.n / (1 + math.exp(-z)) - s.true) / total
            slope += miss
            for key in enumerate(s.traits):
                by[key] += miss
        always -= step * slope
        for key, g in by.items():
            added[key] -= step * g
    return Classifier(always, added)


def vote_counts(spans: DataFrame) -> list[Vote]:
    """Patterns of votes per kind, at most eight each, from :func:`with_votes`."""
    rows = spans.groupBy("kind", "v0", "v1", "v2").agg(F.count("*").alias("n")).collect()
    return sorted(Vote(r.kind, (r.v0, r.v1, r.v2), r.n) for r in rows)


def fit(spans: DataFrame) -> Model:
    """Reliabilities of the labelers, and the classifiers, from :func:`with_votes`.

    The driver gets counts of votes and traits: at most eight patterns of votes for
    each kind, and 8 * 6 * 6 * 6 * 5 * 2 combinations for each of the five loose kinds.
    """
    patterns = vote_counts(spans)
    post = {(p.kind, p.votes): x for p, x in zip(patterns, posteriors(patterns), strict=True)}
    loose = spans.where(F.col("kind") >= BASE).groupBy("kind", "v0", "v1", "v2", *TRAITS)
    rows = sorted(loose.agg(F.count("*").alias("n")).collect())
    votes = [Vote(r.kind, (r.v0, r.v1, r.v2), r.n) for r in rows]
    traits = [tuple(r[t] for t in TRAITS) for r in rows]
    return alternate(votes, traits, [post[v.kind, v.votes] for v in votes])


def alternate(votes: list[Vote], traits: list[tuple[int, ...]], chances: list[float], rounds: int = 30) -> Model:
    """Expectation-maximisation goes on, the classifiers in the place of the kinds' shares.

    Chances by votes alone are drawn towards the middle by every error of a labeler,
    and so would be what the classifiers learn from them. In turns the classifiers
    and the labelers' rates are fitted to the chances, and the chances follow from both.
    """
    classifiers: dict[int, Classifier] = {}
    added: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for kind in {v.kind for v in votes}:
            seen: dict[tuple[int, ...], list[float]] = {}
            for v, t, c in zip(votes, traits, chances, strict=True):
                if v.kind == kind:
                    own = seen.setdefault(t, [0.0, 0.0])
                    own[0] += v.n
                    own[1] += v.n * c
            first = kind not in classifiers
            classifiers[kind] = train(
                [Seen(t, n, true) for t, (n, true) in seen.items()], classifiers.get(kind), 400 if first else 60
            )
        added = _added_by_votes(votes, chances)
        chances = [
            _chance(added[v.votes] + classifiers[v.kind].always + sum(classifiers[v.kind].added[k] for k in enumerate(t)))
            for v, t in zip(votes, traits, strict=True)
        ]
    return Model(classifiers, added)


def _chance(odds: float) -> float:
    return 1 / (1 + math.exp(-odds))


def _added_by_votes(votes: list[Vote], chances: list[float]) -> dict[tuple[int, ...], float]:
    """Log of how much likelier each pattern of votes is for a true candidate than for a false one."""
    out = dict.fromkeys({v.votes for v in votes}, 0.0)
    true = sum(v.n * c for v, c in zip(votes, chances, strict=True))
    every = sum(v.n for v in votes)
    for j in range(len(votes[0].votes) if votes else 0):
        yes = sum(v.n * c for v, c in zip(votes, chances, strict=True) if v.votes[j])
        both = sum(v.n for v in votes if v.votes[j])
        if_true = (yes + PRIOR_VOTES * 0.8) / (true + PRIOR_VOTES)
        if_false = (both - yes + PRIOR_VOTES * 0.1) / (every - true + PRIOR_VOTES)
        for pattern in out:
            ratio = if_true / if_false if pattern[j] else (1 - if_true) / (1 - if_false)
            out[pattern] += math.log(ratio)
    return out


def _looked_up(values: dict, key: Column) -> Column:
    """The value of a key in a small map of literals, 0 where it has none."""
    if not values:
        return F.lit(0.0)
    literals = [F.lit(x) for k, v in values.items() for x in (k, float(v))]
    return F.coalesce(F.try_element_at(F.create_map(*literals), key), F.lit(0.0))


def odds(model: Model) -> Column:
    """Log odds of a loose candidate by its votes and its traits."""
    votes = {"".join(map(str, v)): x for v, x in model.votes.items()}
    total = _looked_up(votes, F.format_string("%d%d%d", "v0", "v1", "v2"))
    total = total + _looked_up({k: c.always for k, c in model.classifiers.items()}, F.col("kind"))
    for j, trait in enumerate(TRAITS):
        own = {
            f"{kind}:{v}": w for kind, c in model.classifiers.items() for (i, v), w in c.added.items() if i == j
        }
        total = total + _looked_up(own, F.format_string("%d:%d", "kind", trait))
    return total


def find_personal_data(
    docs: DataFrame,
    least_score: float = LEAST_SCORE,
    least_votes: int = LEAST_VOTES,
    gazetteer: DataFrame | None = None,
) -> DataFrame:
    """Personal data of each document.

    Takes ``doc_id`` and ``text``; other columns are ignored. Gives per input row:
    doc_id, ``base`` and ``found``, arrays of (start, kind, stop) by start and kind,
    in code points: the strict spans, and these with the looser ones that votes and
    classifier together give a chance of ``least_score``, ``least_votes`` labelers
    being for them. ``gazetteer`` adds entries: ``kind``, one of :data:`KINDS`, and
    ``entry``, as :func:`_keys` makes them; null or unknown ones match nothing. A
    looser candidate that overlaps a strict span is left out. A null or empty text has
    none; repeated rows and null ids keep their rows; an empty table gives none. What
    reaches the driver are counts, see :func:`fit`.
    """
    spark = docs.sparkSession
    seen = keep(candidates(docs).withColumn("row", F.monotonically_increasing_id()), "pii-candidates")
    known = public_codes(spark).unionByName(shown_entries(seen))
    if gazetteer is not None:
        number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind").cast("string")) - 1
        known = known.unionByName(gazetteer.select(number.cast("int").alias("kind"), F.col("entry").cast("string").alias("entry")))
    spans = keep(with_votes(seen, known), "pii-votes")
    model = fit(spans)
    sure = (F.col("v0") + F.col("v1") + F.col("v2") >= least_votes) & (odds(model) >= log_odds(least_score))
    loose = spans.where((F.col("kind") >= BASE) & sure)
    accepted = loose.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "stop")).alias("more"))

    plain = F.transform("base", lambda x: F.struct(x.start.alias("start"), x.kind.alias("kind"), x.stop.alias("stop")))
    alone = seen.where(F.size("weak") == 0).select("doc_id", plain.alias("base"), plain.alias("found"))
    some = seen.where(F.size("weak") > 0).select("row", "doc_id", plain.alias("base")).join(accepted, "row", "left")
    both = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(SPANS))))
    return alone.unionByName(some.select("doc_id", "base", both.alias("found")))


def span_text(spans: str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda x: F.concat_ws(":", F.get(names, x.kind), x.start.cast("string"), x.stop.cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def _is_kind(kind: int):
    return lambda x: x.kind == kind


def digests(found: DataFrame) -> DataFrame:
    """Counts of the strict kinds, a digest of their spans, and all spans as text."""
    counts = [
        F.size(F.filter("base", _is_kind(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(BASE)
    ]
    return found.select("doc_id", *counts, F.sha2(span_text("base"), 256).alias("base_sha256"), span_text("found").alias("spans"))
