"""PII spans by candidate gradient boosting, in DataFrame functions alone.

Generators with high recall propose spans, which may overlap: the base patterns of mail addresses, IP addresses, card and
phone numbers, and looser ones (spelled-out mail addresses, phone numbers without a country code, identity and account numbers, dates of
birth, values given to a key, password or token, and long runs of letters and digits that no word is). Every candidate gets format and
context features. Boosted trees, fitted on the driver on built-in made-up examples (FIT_ROWS of them, no corpus rows), score
the candidates; a threshold for each loose generator selects. It is calibrated for PRECISION on examples of other wordings and formats
than those fitted on. The trees become CASE expressions in the plan. Base matches that pass their rule always stay.

Places are counted in code points. A text is split at its matches; lengths of the pieces, summed in order over one
text's candidates, give the places, so a text with many matches costs no more than its matches.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "id", "secret")
FIT_ROWS = 5600
PRECISION = 0.97
ROUNDS = 40
BEFORE = 24

# Possessive forms of the base patterns: the same matches, without backtracking over long runs. A match starts where a run
# starts or where the last match ended, which is where the leftmost match always starts.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?=[0-9][\x20-]?[0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# name -> (kind of its spans, pattern)
LOOSE = {
    "spelled": ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]|\{at\}| at )\x20?[A-Za-z0-9-]{1,63}+(?:(?:\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?|\x20dot\x20|\.)[A-Za-z]{2,24}+)++"),
    "national": ("phone", r"(?<![0-9A-Za-z+.-])(?<!\+[0-9]{1,3}[\x20.-])(?:\([0-9]{2,4}\)\x20?|0?[0-9]{2,3}[\x20./-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z])"),
    "identity": ("id", r"(?<![0-9A-Za-z-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{1,2}[0-9]{6,9})(?![0-9A-Za-z-])"),
    "account": ("id", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"),
    "birth": ("id", r"(?<![0-9A-Za-z./-])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})(?![0-9A-Za-z./-])"),
    "secret": ("secret", r"(?i)(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{0,32}?(?:token|secret|passwor[dt]|passwd|passphrase|pwd|api_?-?key|access_?-?key|private_?-?key|credential|bearer|auth)[A-Za-z0-9_-]{0,16}+[\"']?[\x20\t]{0,4}(?:[:=]|=>|is)[\x20\t]{0,4}[\"']?[^\s\"'<>,;]{4,256}+"),
    "run": ("secret", r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]{0,64}[0-9])[A-Za-z0-9+/_-]{20,256}+={0,2}+(?![A-Za-z0-9+/_=-])"),
}
#: The value at the end of a secret's match.
VALUE = r"(?:[:=]|=>|is)[\x20\t]{0,4}[\"']?([^\s\"'<>,;]{4,256})$"
CUES = "mail|contact|write|reach|phone|tel|call|fax|mobile|cell|ssn|social|security|tax|iban|account|acct|bank|passport|licen[cs]e id|id no|born|birth|dob|geb"
SECRET_CUES = "token|secret|passw|passphrase|pwd|key|credential|bearer|auth"
PUBLIC_CUES = "commit|sha|digest|checksum|revision|build|version|order|invoice|isbn|part|item|article|uuid|etag"
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

FEATURES = ("length", "digits", "letters", "marks", "groups", "kinds", "capitals", "hex", "number", "word", "cue", "secret_cue", "public_cue", "quoted", "glued_before", "brackets", *LOOSE)
PATTERNS = {"hex": "^[0-9a-fA-F]+$", "number": "^[0-9.,]+$", "word": "^[a-z_.()-]+$"}
CONTEXT = {"cue": CUES, "secret_cue": SECRET_CUES, "public_cue": PUBLIC_CUES}


def features_of(name: str, value: str, before: str) -> list[float]:
    """A candidate's features; feature_columns has the same as expressions."""

    def count(pattern: str) -> float:
        return float(len(re.findall(pattern, value)))

    return [
        float(len(value)), count("[0-9]"), count("[A-Za-z]"), count("[^0-9A-Za-z]"), count("[0-9]+"), float(len(set(value))), count("[A-Z]"), *(float(bool(re.search(p, value))) for p in PATTERNS.values()),
        *(float(bool(re.search(p, before.lower()))) for p in CONTEXT.values()), float(bool(re.search("[\"']$", before))), float(bool(re.search("[0-9A-Za-z]$", before))), count(r"[\[({]"), *(float(name == x) for x in LOOSE),
    ]


def feature_columns(name: Column, value: Column, before: Column) -> dict[str, Column]:
    def count(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)).cast("double")

    low = F.lower(before)
    out = {"length": F.length(value).cast("double"), "digits": count("[0-9]"), "letters": count("[A-Za-z]"), "marks": count("[^0-9A-Za-z]"), "groups": count("[0-9]+"), "kinds": F.size(F.array_distinct(F.filter(F.split(value, ""), lambda c: c != ""))).cast("double"), "capitals": count("[A-Z]")}
    out |= {k: value.rlike(p).cast("double") for k, p in PATTERNS.items()} | {k: low.rlike(p).cast("double") for k, p in CONTEXT.items()}
    out |= {"quoted": before.rlike("[\"']$").cast("double"), "glued_before": before.rlike("[0-9A-Za-z]$").cast("double"), "brackets": count(r"[\[({]")}
    return out | {x: (name == x).cast("double") for x in LOOSE}


# Wordings and formats of the examples: those fitted on, and others to calibrate with.
WORDINGS = (
    {"spelled": ("email: ", "contact ", "write to "), "national": ("tel. ", "phone: ", "call "), "identity": ("SSN: ", "social security ", "passport "), "account": ("IBAN ", "account: "), "birth": ("born ", "date of birth: "), "public": ("commit ", "sha1 ", "order ", "invoice no ", "uuid ")},
    {"spelled": ("mail me: ", "reach me at ", "my e-mail is "), "national": ("mobile ", "fax ", "cell: "), "identity": ("tax id ", "security number ", "licence id "), "account": ("bank account ", "acct. "), "birth": ("dob ", "geb. "), "public": ("revision ", "checksum: ", "part ", "build ", "digest ")},
)
SECRET_KEYS = (("token", "api_key", "password", "AWS_SECRET", "auth_token"), ("secret", "access-key", "pwd", "client_secret", "GITHUB_TOKEN", "Bearer"))


def made_up(n: int, seed: int, other: bool = False) -> list[tuple[str, str, str, int]]:
    """(generator, value, before, private) examples; other: of the second wordings and formats."""
    r = random.Random(seed)
    say, keys = WORDINGS[other], SECRET_KEYS[other]
    pick = lambda letters, k: "".join(r.choice(letters) for _ in range(k))
    digits = lambda k: pick("0123456789", k)
    word = lambda: pick("etaoinshrdlu", r.randint(2, 8))
    plain = lambda: f"{word()} {word()} {word()} "[-BEFORE:]
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    out = []
    for i in range(n):
        name, private = list(LOOSE)[i % len(LOOSE)], r.random() < 0.5
        cued = lambda share: plain() if r.random() >= share else f"{word()} {r.choice(say[name])}"  # noqa: E731, B023
        before = cued(0.65 if private else 0.02) if name in say else plain()
        if name == "spelled":
            at = r.choice(["(at)", "[at]", " [at] "] if not other else [" (at) ", "{at}", "[at]"]) if private and r.random() < 0.8 else " at "
            dot = r.choice(["[dot]", "(dot)", " dot "] if not other else [" [dot] ", "(dot)", " dot "]) if private else r.choice([".", ".", " dot "])
            value = word() + r.choice(["", ".", "_"]) + (digits(2) if private and r.random() < 0.4 else "") + at + word() + dot + (r.choice(["com", "org", "net"]) if private else word() + "xx")
            before = before if private else plain()
        elif name == "national":
            good = [f"({digits(3)}) {digits(3)}-{digits(4)}", f"0{digits(2)} {digits(4)} {digits(4)}"] if not other else [f"({digits(4)}) {digits(4)}-{digits(4)}", f"0{digits(2)}-{digits(3)}-{digits(4)}", f"({digits(3)}){digits(3)}-{digits(4)}"]
            value = r.choice(good if private else [f"{digits(3)}.{digits(3)}.{digits(3)}", f"{digits(2)}/{digits(4)}-{digits(4)}", f"{digits(3)} {digits(3)} {digits(3)}"])
        elif name == "identity":
            value = r.choice([f"{digits(3)}-{digits(2)}-{digits(4)}", pick("ABCXYZ", r.randint(1, 2)) + digits(r.randint(6, 9))])
            before = f"{word()} {r.choice(say[name])}" if private else plain() if r.random() < 0.7 else f"{word()} {r.choice(say['public'])}"
        elif name == "account":
            value = pick("ABDEFGINST", 2) + digits(2) + "".join(" " + (digits(4) if private else pick("ABCDEF0123", 4)) for _ in range(r.randint(3, 6)))
            before = before if private else plain()
        elif name == "birth":
            value = r.choice([f"{r.randint(1, 28)}.{r.randint(1, 12)}.19{digits(2)}", f"19{digits(2)}-0{r.randint(1, 9)}-1{digits(1)}", f"{r.randint(1, 28)}/{r.randint(1, 12)}/20{digits(2)}"])
            before = f"{word()} {r.choice(say[name])}" if private else plain() if r.random() < 0.8 else f"{word()} {r.choice(say['public'])}"
        else:
            strong = [pick("0123456789abcdef", r.choice([32, 40, 64])), pick(mixed, r.randint(20, 44)), "AKIA" + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16)] if not other else [pick("0123456789ABCDEF", r.choice([32, 40])), "sk-" + pick(mixed, 32), "ghp_" + pick(mixed, 36), pick(mixed + "+/", 40)]
            short = [word().capitalize() + digits(3) + r.choice("!#$%"), pick(mixed, r.randint(8, 14)) + digits(1)]
            quote = r.choice(["", '"', "'"])
            if name == "secret":
                value = r.choice(strong + short) if private else r.choice([f"{word()}_{word()}()", word(), "required", "None", f"{word()}.{word()}", digits(r.randint(4, 5)), f"{word()}-{word()}"])
                before = f"{word()} {r.choice(keys)}{r.choice([' = ', ': ', '=', ' is '])}"[-BEFORE:] + (quote if private else "")
            else:
                value = r.choice(strong) if private else r.choice([f"{word()}-{digits(2)}-{word()}-{word()}-{word()}", f"{word()}/{word()}/{word()}/{digits(4)}/{word()}", f"{word()}_{word()}_{word()}_{digits(2)}_{word()}", pick("0123456789abcdef", 40), digits(r.randint(20, 30))])
                public = not private and re.fullmatch("[0-9a-f]{40}", value)
                before = f"{word()} {r.choice(say['public'])}" if public else plain() + quote if r.random() < 0.6 or not private else f"{word()} {r.choice(keys)} = " + quote
        out.append((name, value, before[-BEFORE:], int(private)))
    return out


@dataclass(frozen=True)
class Boosted:
    """Trees of depth two as (feature, cut, then both sides' (feature, cut, low, high)), and a threshold for each loose generator."""

    start: float
    trees: tuple
    thresholds: dict

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for f, c, low, high in self.trees:
            for mask, (g, d, a, b) in ((x[:, f] <= c, low), (x[:, f] > c, high)):
                out += np.where(mask, np.where(x[:, g] <= d, a, b), 0.0)
        return out

    def column(self, columns: dict[str, Column]) -> Column:
        out = F.lit(self.start)
        at = [columns[f] for f in FEATURES]
        for f, c, low, high in self.trees:
            low_, high_ = (F.when(at[g] <= d, F.lit(a)).otherwise(F.lit(b)) for g, d, a, b in (low, high))
            out = out + F.when(at[f] <= c, low_).otherwise(high_)
        return out


def _stump(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray) -> tuple[int, float, float]:
    """(feature, cut, gain) of the best split."""
    best = (0, 0.0, -1.0)
    if not len(x):
        return best
    g, w = gradient.sum(), weight.sum()
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v = x[order, f]
        ends = np.flatnonzero(np.diff(v) > 0)
        if len(ends):
            gl, wl = np.cumsum(gradient[order])[ends], np.cumsum(weight[order])[ends]
            gain = gl**2 / (wl + 1.0) + (g - gl) ** 2 / (w - wl + 1.0)
            i = int(np.argmax(gain))
            if gain[i] > best[2]:
                best = (f, float(v[ends[i]]), float(gain[i]))
    return best


@lru_cache(maxsize=1)
def fitted() -> Boosted:
    """Trees by second-order logistic boosting; a threshold is the least score that keeps PRECISION on the other examples."""

    def table(rows: list) -> tuple[np.ndarray, np.ndarray]:
        return np.array([features_of(*r[:3]) for r in rows]), np.array([r[3] for r in rows], float)

    (x, y), others = table(made_up(FIT_ROWS, 11)), made_up(FIT_ROWS // 2, 12, other=True)
    start = float(np.log(y.mean() / (1 - y.mean())))
    score, trees = np.full(len(y), start), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = y - p, p * (1 - p)
        f, c, _gain = _stump(x, gradient, weight)
        sides = []
        for mask in (x[:, f] <= c, x[:, f] > c):
            g, d, _gain = _stump(x[mask], gradient[mask], weight[mask])
            leaf = [0.3 * float(gradient[m].sum() / (weight[m].sum() + 1.0)) for m in (mask & (x[:, g] <= d), mask & (x[:, g] > d))]
            sides.append((g, d, *leaf))
            score[mask] += np.where(x[mask, g] <= d, *leaf)
        trees.append((f, c, *sides))
    model = Boosted(start, tuple(trees), {})
    held, truth = table(others)
    held, names = model.score(held), np.array([r[0] for r in others])
    thresholds = {}
    for name in LOOSE:
        order = np.argsort(-held[names == name], kind="stable")
        s, t = held[names == name][order], truth[names == name][order]
        good = np.flatnonzero((np.cumsum(t) / np.arange(1, len(t) + 1) >= PRECISION) & (np.append(s[1:], -np.inf) < s))
        thresholds[name] = float(s[good[-1]]) if len(good) else float("inf")
    return Boosted(start, tuple(trees), thresholds)


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    # from the right, every second digit doubles, and 9 goes from what exceeds it
    place = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    luhn = F.aggregate(place, F.lit(0), lambda total, i: total + F.when(F.pmod(i, F.lit(2)) == 1, _digit(digits, n, i)).otherwise(_doubled(_digit(digits, n, i))))
    card = n.between(13, 19) & F.when(n.between(13, 19), luhn % 10 == 0).otherwise(False)
    return F.when(kind == "ip", match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")).when(kind == "card", card).when(kind == "phone", n.between(9, 15)).otherwise(True)


def _digit(digits: Column, n: Column, i: Column) -> Column:
    return F.ascii(F.substr(digits, n - i + 1, F.lit(1))) - 48


def _doubled(d: Column) -> Column:
    return F.when(d > 4, 2 * d - 9).otherwise(2 * d)


def _candidates(text: Column, name: str, pattern: str) -> Column:
    """array<struct>: generator, match and the piece before it, in order. The lambdas see one element, never the whole text."""
    zipped = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"), F.split(text, pattern, -1).alias("gap"))
    hits = F.filter(zipped, lambda s: s["match"].isNotNull())
    return F.transform(hits, lambda s, i: F.struct(F.lit(name).alias("name"), i.alias("place"), s["match"].alias("match"), F.length(s["gap"]).alias("gap"), F.right(s["gap"], F.lit(BEFORE)).alias("before")))


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, a count n_email .. n_phone of base spans, base (array of kind, start, end) and found (base and added spans), one row per document.

    Spans are ordered by kind as in KINDS, then start. Added spans never overlap base ones; of added spans that overlap each other,
    both stay. A null text is empty; an empty table gives an empty one. Repeated rows are judged alike, texts are read whole, and columns of
    other names are not read.
    """
    model = fitted()
    whole = F.coalesce(F.col(text), F.lit(""))
    held = docs.select(F.col(key).alias("__key"), whole.alias("__text")).withColumn("__row", F.monotonically_increasing_id())
    # what no match can do without spares most texts the search
    body = F.col("__text")
    digit, at = body.rlike("[0-9]"), F.lower("__text").contains("at")
    need = {"email": body.contains("@"), "ip": digit, "card": digit, "phone": body.contains("+"), "spelled": at, "secret": F.lower("__text").rlike(SECRET_CUES), "run": digit & body.rlike("[A-Za-z0-9+/_-]{20}")}
    patterns = BASE | {n: p for n, (_, p) in LOOSE.items()}
    proposals = F.concat(*(F.coalesce(F.when(need.get(n, digit), _candidates(body, n, p)), F.array().cast("array<struct<name:string,place:int,match:string,gap:int,before:string>>")) for n, p in patterns.items()))
    each = held.select("__key", "__row", F.explode_outer(proposals).alias("c")).select("__key", "__row", "c.*")
    base, keyed = F.col("name").isin(*BASE), F.col("name") == "secret"
    # of a secret the value alone is the span, and its key belongs to what stands before
    value = F.when(keyed, F.regexp_extract("match", VALUE, 1)).otherwise(F.col("match"))
    each = each.withColumn("value", value)
    ahead = F.when(keyed, F.right(F.concat("before", F.left("match", F.length("match") - F.length("value"))), F.lit(BEFORE))).otherwise(F.col("before"))
    each = each.withColumn("before", ahead)
    ready = each.withColumns(feature_columns(F.col("name"), F.col("value"), F.col("before")) | {"base": base, "valid": F.when(base, _valid(F.col("name"), F.col("match")))})
    score = model.column({f: F.col(f) for f in FEATURES})
    threshold = F.lit(float("inf"))
    for n, t in model.thresholds.items():
        threshold = F.when(F.col("name") == n, F.lit(t)).otherwise(threshold)
    ready = ready.withColumn("ok", F.when(F.col("base"), F.col("valid")).otherwise((score >= threshold) & (F.length("value") > 0)))
    # one dealing serves the places and the rows of a text; candidates are judged before it, once each
    ready = ready.select("__key", "__row", "name", "place", "gap", F.length("match").alias("size"), F.length("value").alias("length"), "base", "ok").repartition("__row")
    in_order = Window.partitionBy("__row", "name").orderBy("place")
    kind = F.col("name")
    for n, (k, _) in LOOSE.items():
        kind = F.when(F.col("name") == n, k).otherwise(kind)
    placed = ready.withColumns({"end": F.sum(F.col("gap") + F.col("size")).over(in_order), "kind": kind})
    order = F.lit(len(KINDS))
    for i, k in enumerate(KINDS):
        order = F.when(F.col("kind") == k, i).otherwise(order)
    span = F.struct(order.alias("order"), (F.col("end") - F.col("length")).cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.col("kind").alias("kind"))
    rows = placed.groupBy("__row").agg(
        F.first("__key").alias(key),
        *(F.count(F.when(F.col("base") & F.col("ok") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE),
        F.array_sort(F.collect_list(F.when(F.col("base") & F.col("ok"), span))).alias("base"),
        F.collect_set(F.when(~F.col("base") & F.col("ok"), span)).alias("more"),
    )
    apart = F.filter("more", lambda a: ~F.exists("base", lambda b: (a["start"] < b["end"]) & (b["start"] < a["end"])))
    return rows.select(key, *(f"n_{k}" for k in BASE), "base", F.array_sort(F.concat("base", apart)).alias("found"))


def as_text(array: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

