"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Generators with high recall propose spans, which may overlap. Format features of
a span and features of its context go into gradient-boosted trees, fitted on
labelled snippets that a rule writes; each generator gets the lowest threshold
at which snippets set aside for calibration reach the wanted precision. Spans of
the four fixed formats (mail addresses, IP addresses, card numbers with a right
check digit, international phone numbers) are always selected; the method adds
others: further phone numbers, national identity numbers, account numbers, card
numbers with a wrong digit, spelt-out mail addresses, secrets, passwords that are
said to be such, and numbers of identity documents.

Candidates, features, forest and redaction are Spark expressions over the row's
text. Places of matches follow from the lengths of matches and of what lies
between them, summed in two levels, so a text with many matches costs little
more than linear time.

Defined cases: a null text has no spans and stays null when redacted; an empty
text has none; equal rows get equal results; an empty table gives an empty
result; other columns are kept, whatever their names.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import boosting
from tessella.llm.common import documents, let, text_of

# The fixed formats. Possessive quantifiers and a start at the end of the last match or after
# another character find the same matches as the plain patterns, in linear time.
_LOCAL, _HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_HOST}]++(?:\.[{_HOST}]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
IP_RIGHT = rf"^{_PART}(?:\.{_PART}){{3}}$"

#: Generators of candidates, by kind. The twelve groups of ``number`` have 24 digits at least, more than
#: phone, card and identity numbers have; Java's matcher takes stack for each group.
GENERATORS = {
    "email_spelt": r"(?<![\w.+-])[\w.+-]++(?:\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20)[\w-]++(?:(?:\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20)[\w-]++)++",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "number": r"(?<![A-Za-z0-9])(?<![0-9][.,])\(?[0-9]{2,19}(?:(?:\)[\x20./-]{0,3}|[\x20./-]{1,3})[0-9]{2,12}){0,11}\)?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])[A-Za-z0-9+/_-]{12,}+",
    "secret_told": r"(?<=[:=\x20\"'])(?<=(?i:password|passwd|passphrase|pwd|secret|passcode)[\"']?\x20{0,2}[:=]\x20{0,2}[\"']?)[^\s\"':=]{5,}+",
    "document": r"(?<![A-Za-z0-9])(?=[0-9]*[A-Z])(?=[A-Z]*[0-9])[A-Z0-9]{6,12}+(?![A-Za-z0-9])",
}
#: What a text has that can hold candidates of a kind; looking back from every place is dear.
GUARDS = {"secret_told": "(?i:passw|passphrase|passcode|pwd|secret)"}
#: Precision that a generator's threshold must reach on the calibration snippets.
PRECISION = 0.98
CONTEXT = 28
CUES = {
    "secret_cue": "pass(?:word|wd|phrase)?|pwd|token|secret|api[ _-]?key|access[ _-]?key|credential|bearer|key",
    "person_cue": "ssn|social security|passport|tax id|national id|identity|licen[cs]e no|id no|id:|insurance",
    "phone_cue": "phone|tel|call|mobile|fax|cell|contact|sms|whatsapp",
    "bank_cue": "iban|account|bank|card|visa|mastercard|credit|debit|amex",
    "plain_cue": "version|isbn|page|figure|section|article|between|year|chapter|order|build|commit|sha|md5|checksum|part|model",
}


def running_sums(values: Column) -> Column:
    """Sums of what stands before each item, in blocks of 256."""
    block = 256
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)

    def of(v: Column) -> Column:
        n_blocks = F.ceil(F.size(v) / block).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: total(F.slice(v, b * block + 1, F.lit(block))))
        bases = lambda s: F.transform(s, lambda _, b: total(F.slice(s, F.lit(1), b)))
        place = lambda base, i: F.get(base, F.floor(i / block).cast("int")) + total(F.slice(v, (i - i % block) + 1, i % block))
        return let(let(blocks, bases), lambda base: F.transform(v, lambda _, i: place(base, i)))

    return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(let(values, of))


def matches(text: Column, pattern: str) -> Column:
    """All matches, as an array of (start, end, value) in code points."""

    def placed(found: Column) -> Column:
        between = F.split(text, pattern, -1)

        def spans(parts: Column) -> Column:
            lengths = F.zip_with(parts, found, lambda p, m: F.char_length(p) + F.coalesce(F.char_length(m), F.lit(0)))

            def span(before: Column, m: Column, i: Column) -> Column:
                start = F.get(before, i) + F.char_length(F.get(parts, i))
                return F.struct(start.alias("start"), (start + F.char_length(m)).alias("end"), m.alias("value"))

            return let(running_sums(lengths), lambda before: F.transform(found, lambda m, i: span(before, m, i)))

        empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
        return F.when(F.size(found) == 0, empty).otherwise(let(between, spans))

    return let(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), placed)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the check digit is right: every second digit from the right counts twice."""

    def digit(i: Column) -> Column:
        d = F.substring(digits, -(i + 1), F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    every = F.sequence(F.lit(0), F.char_length(digits) - 1)
    return F.aggregate(every, F.lit(0), lambda s, i: s + digit(i)) % 10 == 0


def base_spans(text: Column, kind: str) -> Column:
    n = lambda s: F.char_length(digits_of(s["value"]))
    right = {
        "email": None,
        "ip": lambda s: s["value"].rlike(IP_RIGHT),
        "card": lambda s: F.when(n(s).between(13, 19), luhn(digits_of(s["value"]))).otherwise(False),
        "phone": lambda s: n(s).between(9, 15),
    }[kind]
    found = matches(text, BASE[kind])
    if kind == "email":
        found = F.when(F.contains(text, F.lit("@")), found).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))
    return F.filter(found, right) if right else found


# --- features -----------------------------------------------------------------------------

FEATURES = [
    "length", "digit_share", "upper_share", "lower_share", "variety", "hexadecimal", "groups", "digits", "check_digit",
    "upper_prefix", "opens_as_card", "digit_steps", *CUES, "assigned", "quoted", "ends_as_domain",
]


def features(text: Column, s: Column) -> list[Column]:
    """Format features of span ``s`` and features of the text around it, in the order of FEATURES."""
    v = s["value"]
    n = F.char_length(v)
    share = lambda p: F.char_length(F.regexp_replace(v, f"[^{p}]", "")) / n
    digits = digits_of(v)
    n_digits = F.char_length(digits)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    before = F.lower(F.substring(text, F.greatest(s["start"] - CONTEXT + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT))))
    return [
        n.cast("double"),
        share("0-9"),
        share("A-Z"),
        share("a-z"),
        F.size(F.array_distinct(F.split(v, ""))) / n,
        flag(v.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        F.regexp_count(v, F.lit("[0-9A-Za-z]+")).cast("double"),
        n_digits.cast("double"),
        flag(F.when(n_digits.between(2, 24), luhn(digits)).otherwise(False)),
        flag(v.rlike("^[A-Z]{4}[A-Z0-9]+$")),
        flag(v.rlike("^[3-6]")),
        F.regexp_count(v, F.lit("[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])")) / n,
        *(flag(before.rlike(f"(?:^|[^a-z])(?:{p})")) for p in CUES.values()),
        flag(before.rlike(r"[=:]\s*[\"']?$")),
        flag(before.rlike(r"[\"'`]$")),
        flag(v.rlike(r"(?:[\])}]\x20?|\x20)(?:com|org|net|edu|gov|info|biz|[a-z]{2})$")),
    ]


# --- labelled snippets --------------------------------------------------------------------


#: Snippets of each kind; every second one is set aside for calibration.
SNIPPETS = 1200


def labelled_snippets(n: int = SNIPPETS, seed: int = 11) -> list[tuple[str, str, str, int]]:
    """(kind, text, value, label): rule-written examples, ``n`` of a kind, half of them look-alikes."""
    rng = np.random.default_rng(seed)
    pick = lambda x: x[int(rng.integers(len(x)))]
    some = lambda alphabet, k: "".join(pick(alphabet) for _ in range(k))
    dec, low, up = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    word = lambda: some(low, int(rng.integers(2, 10)))
    prose = lambda: " ".join(word() for _ in range(int(rng.integers(2, 7))))

    def card() -> str:
        d = pick("3456") + some(dec, 14)
        total = sum(int(c) if i % 2 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(d))
        d += str(-total % 10)
        return pick([d, " ".join(d[i : i + 4] for i in (0, 4, 8, 12)), "-".join(d[i : i + 4] for i in (0, 4, 8, 12))])

    def secret() -> tuple[str, str]:
        v = pick([lambda: some("0123456789abcdef", pick([16, 18, 20, 32, 40, 64])), lambda: some(up, 4) + some(up + dec, 15) + pick(dec), lambda: some(up + low + dec, int(rng.integers(20, 44))) + pick(dec), lambda: pick(["sk", "ghp", "pk"]) + "_" + some(up + low + dec, 30) + pick(dec)])()
        lead = pick(["password=", 'token = "', "token: ", "secret=", "api_key: '", "key ", "", "", "access key ", "Bearer "])
        return lead, v

    def one(kind: str, label: int) -> tuple[str, str]:
        if kind == "secret":
            if label:
                return secret()
            return pick([
                lambda: ("", some(low, int(rng.integers(10, 20))) + pick(dec)), lambda: ("chapter ", some(low, 6) + "-" + some(low, 7) + "-" + some(dec, 2)),
                lambda: ("on ", f"20{some(dec, 2)}-0{pick('123456789')}-1{pick(dec)}-{some(low, 4)}"), lambda: ("", some(low, 8) + "/" + some(low, 6) + "/" + some(dec, 4)),
                lambda: ("", pick(up) + some(low, 9) + "_" + some(dec, 1)), lambda: ("number ", "1" + "0" * int(rng.integers(12, 16))), lambda: ("", "-" * 12 + some(dec, 1)),
                lambda: ("since ", some(dec, 4) + "-" + some(low, 9)), lambda: ("commit ", some(low, 12) + some(dec, 1)),
            ])()
        if kind == "account":
            if label:
                d = some(up, 2) + some(dec, 2) + some(dec, pick([14, 16, 18, 20]))
                return pick(["IBAN ", "account ", "iban: ", ""]), pick([d, " ".join(d[i : i + 4] for i in range(0, len(d), 4))])
            return pick(["model ", "part ", ""]), some(up, 2) + some(dec, 2) + " " + some(up, 4) + " " + some(up, 4)
        if kind == "email_spelt":
            a, b = pick([("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", " (dot) "), (" at ", " dot ")])
            if label:
                name, host = pick([word(), word()[:3], word() + pick("._") + word(), word() + pick(dec)]), pick([word(), word() + "-" + word(), word() + b + word()])
                return pick(["", "mail ", "contact ", "to "]), name + a + host + b + pick(["com", "org", "net", "edu", "info", some(low, 2)])
            return "", pick([word(), "we", "look", "stay"]) + a + pick(["noon", "once", "home", word()]) + b + some(low, int(rng.integers(5, 9)))
        if kind == "secret_told":
            if label:
                v = "".join(pick([pick(low), pick(up), pick(dec), pick(dec), pick("!#$%&*+-?@^_~.")]) for _ in range(int(rng.integers(6, 18))))
                v = pick([v, word().capitalize() + some(dec, int(rng.integers(1, 4))) + pick("!?#$") + some(low, 1), word() + some(dec, int(rng.integers(2, 5)))])
                return pick(["password: ", "Password=", "pwd: ", 'passwd = "', "passphrase: ", "secret: '", "passcode: "]), v if len(v) > 5 else v + some(dec, 5)
            return pick(["password: ", "Password: ", "pwd = ", "secret: ", "passphrase: "]), pick(["required", "optional", word() + some(low, 5), "hidden", "see", "ask"]) + some(low, 3) + pick(["", ",", "."])
        if kind == "document":
            if label:
                v = pick([lambda: pick(up) + some(dec, 8), lambda: pick(up) + some(dec, 2) + pick(up) + some(dec, 2) + pick(up) + some(dec, 2), lambda: some(up, 2) + some(dec, 7), lambda: pick(up) + some(up + dec, 7) + pick(dec)])()
                return pick(["passport ", "passport no ", "Passport: ", "national id ", "identity card ", "licence no ", "license no. ", "tax id "]), v
            return pick(["model ", "part ", "", "", "flight ", "order ", "version ", "section ", "commit ", "from "]), pick([lambda: some(up, 3) + some(dec, 4), lambda: some(up, int(rng.integers(2, 6))) + some(dec, int(rng.integers(4, 7))), lambda: pick(up) + some(up + dec, 7) + pick(dec), lambda: some(dec, 4) + some(up, 2)])()
        if label:
            return pick([
                lambda: (pick(["ssn ", "SSN: ", "social security number ", ""]), f"{some(dec, 3)}-{some(dec, 2)}-{some(dec, 4)}"),
                lambda: (pick(["tel ", "phone: ", "call ", "", "mobile ", word() + ",", "phone."]), pick([f"({some(dec, 3)}) {some(dec, 3)}-{some(dec, 4)}", f"({some(dec, 3)}){some(dec, 3)}-{some(dec, 4)}", f"{some(dec, 3)}-{some(dec, 3)}-{some(dec, 4)}", f"{some(dec, 3)} - {some(dec, 3)} - {some(dec, 4)}", f"0{some(dec, pick([2, 3, 4]))}/{some(dec, pick([6, 7, 8]))}", f"{some(dec, 3)}.{some(dec, 3)}.{some(dec, 4)}"])),
                lambda: (pick(["tel ", "phone: ", "call ", "mobile "]), "0" + some(dec, 2) + "".join(" " + some(dec, pick([2, 3])) for _ in range(int(rng.integers(2, 7))))),
                lambda: (pick(["card ", "", "visa ", ""]), card()),
                lambda: (pick(["passport ", "national id ", "tax id: "]), some(dec, int(rng.integers(8, 12)))),
                lambda: (pick(["phone ", "tel: ", "call me at "]), "0" + some(dec, int(rng.integers(8, 11)))),
            ])()
        return pick([
            lambda: ("", pick(["19", "20"]) + some(dec, 2)), lambda: ("on ", f"{some(dec, 2)}/{some(dec, 2)}/20{some(dec, 2)}"), lambda: ("on ", f"20{some(dec, 2)}-{some(dec, 2)}-{some(dec, 2)}"),
            lambda: (pick(["page ", "", "about ", "section "]), some(dec, int(rng.integers(2, 7)))), lambda: ("version ", f"{some(dec, 2)}.{some(dec, 2)}"), lambda: ("between ", f"19{some(dec, 2)}-19{some(dec, 2)}"),
            lambda: ("", pick("123456789") + some(dec, 15)), lambda: ("isbn ", "978" + some(dec, 10)), lambda: ("order ", some(dec, int(rng.integers(5, 10)))), lambda: ("", f"{some(dec, 2)} {some(dec, 3)}"), lambda: ("years ", f"20{some(dec, 2)} 20{some(dec, 2)} 20{some(dec, 2)}"),
            lambda: ("total ", some("123456789", 1) + "000000000"), lambda: ("", f"{some(dec, 2)} {some(dec, 2)} {some(dec, 2)}"),
        ])()

    out = []
    for k, kind in enumerate(GENERATORS):
        rng = np.random.default_rng([seed, k])  # a kind's snippets don't depend on the others'
        for _ in range(n):
            label = int(rng.integers(2))
            lead, value = one(kind, label)
            out.append((kind, f"{prose()} {lead}{value}{pick([' ', '. ', ', ', chr(10)])}{prose()}", value, label))
    return out


@lru_cache(maxsize=1)
def _fitted(app: str) -> tuple[dict, dict]:
    """Forest and threshold of each generator."""
    spark = SparkSession.getActiveSession()
    rows = [{"kind": k, "text": t, "value": v, "label": y, "fold": i % 2} for i, (k, t, v, y) in enumerate(labelled_snippets())]
    given = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), "array<struct<kind:string,text:string,value:string,label:int,fold:int>>")).alias("r")).select("r.*")
    span = F.struct((F.instr("text", F.col("value")) - 1).alias("start"), F.char_length("value").alias("end"), F.col("value").alias("value"))
    table = given.select("kind", "label", "fold", F.array(*features(F.col("text"), span)).alias("x")).collect()
    forests, thresholds = {}, {}
    for kind in GENERATORS:
        x = np.array([r["x"] for r in table if r["kind"] == kind])
        y = np.array([r["label"] for r in table if r["kind"] == kind])
        fold = np.array([r["fold"] for r in table if r["kind"] == kind])
        forests[kind] = boosting.fit(x[fold == 0], y[fold == 0])
        m, t = boosting.margins(forests[kind], x[fold == 1]), y[fold == 1]
        order = np.argsort(-m, kind="stable")
        right = np.cumsum(t[order]) / np.arange(1, len(t) + 1)
        good = np.flatnonzero(right >= PRECISION)
        thresholds[kind] = max(0.0, float(m[order][good[-1]])) if len(good) else float("inf")
    return forests, thresholds


def fitted(spark: SparkSession) -> tuple[dict, dict]:
    return _fitted(spark.sparkContext.applicationId)


def added_spans(text: Column, kind: str, model: tuple[dict, dict], base: list[Column]) -> Column:
    """The generator's selected spans that no base span covers."""
    forests, thresholds = model

    def selected(s: Column) -> Column:
        free = F.lit(True)
        for b in base:
            free = free & ~F.exists(b, lambda o: (o["start"] <= s["start"]) & (s["end"] <= o["end"]))
        return free & (let(F.array(*features(text, s)), lambda x: boosting.expression(forests[kind], [F.get(x, F.lit(i)) for i in range(len(FEATURES))])) >= thresholds[kind])

    found = matches(text, GENERATORS[kind])
    if kind in GUARDS:
        found = F.when(text.rlike(GUARDS[kind]), found).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))
    return F.filter(found, selected)


def find_spans(df: DataFrame, text_column: str = "text", prefix: str = "pii_") -> DataFrame:
    """Add one array of (start, end, value) a kind, named by ``prefix`` and the kind."""
    model = fitted(df.sparkSession)
    text = text_of(text_column)
    with_base = df.select("*", *(base_spans(text, k).alias(prefix + k) for k in BASE))
    base = [F.col(prefix + k) for k in BASE]
    return with_base.select("*", *(added_spans(text, k, model, base).alias(prefix + k) for k in GENERATORS))


def _listed(kind: str, column: str) -> Column:
    return F.transform(F.col(column), lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def redact(df: DataFrame, text_column: str = "text") -> DataFrame:
    """Replace selected spans by ``[kind]``; spans that overlap become one, named after the first."""
    prefix = "__pii_"
    found = find_spans(df, text_column, prefix)
    kinds = [*BASE, *GENERATORS]

    def tagged(kind: str) -> Column:
        return F.transform(F.col(prefix + kind), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    every = F.flatten(F.array(*map(tagged, kinds)))
    text = F.col(text_column)

    def step(acc: Column, s: Column) -> Column:
        inside = s["start"] < acc["at"]
        between = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], between, F.lit("["), s["kind"], F.lit("]"))).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text)))
    redacted = F.when(F.size("__spans") == 0, text).otherwise(F.aggregate(F.col("__spans"), start, step, done))
    kept = [F.col(f"`{c}`") for c in df.columns]
    return found.select(*kept, F.sort_array(every).alias("__spans")).select(*(redacted.alias(c) if c == text_column else F.col(f"`{c}`") for c in df.columns))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of personal data in every document; ``n_spans`` counts all of them, those of the method too."""
    found = find_spans(documents(spark, sf_dir).select("doc_id", "text"))
    listed = {k: F.concat_ws(",", _listed(k, "pii_" + k)) for k in [*BASE, *GENERATORS]}
    joined = lambda kinds: F.concat_ws(",", *(F.when(F.size("pii_" + k) > 0, listed[k]) for k in kinds))
    return found.select(
        "doc_id",
        *(F.size("pii_" + k).cast("long").alias("n_" + k) for k in BASE),
        F.sha2(joined(BASE), 256).alias("base_sha256"),
        joined([*BASE, *GENERATORS]).alias("spans"),
        sum((F.size("pii_" + k) for k in [*BASE, *GENERATORS]), F.lit(0)).cast("long").alias("n_spans"),
    )
