"""Secret scans: three base patterns, and password guess costs by dynamic programming
for values that stand in a credential context."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns and the least lengths of what they must match.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "guess")

# Words around a credential, in the languages of the corpus, and what joins them to a value. The value is looked ahead for, so every keyword is tried.
CONTEXT = re.compile(
    r"""(?ai:(?<![a-z])(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|api[_-]?key|auth(?:orization)?|bearer|credentials?|login|kennwort|passwort|contrase(?:n|ñ)a|clave|mot de passe)(?:[_-][a-z0-9]+)*(?![a-z]))"""
    r"""(?=["']?(?:\x20*(?:[:=]|=>|\x20is\x20)\x20*|\x20+)["']?([^\x20\x09-\x0D"']{8,}))"""
)
# A user's value in an address.
ADDRESS = re.compile(r"""://[^\x20\x09-\x0D"'/:@]*:([^\x20\x09-\x0D"'/@]{8,})@""")
# Keyboard rows, whose runs are cheap to guess.
WALKS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiop", "azertyuiop", "abcdefghijklmnopqrstuvwxyz", "1qaz2wsx3edc")
# Words that passwords are often made of, the most frequent first.
COMMON = ("password", "admin", "welcome", "login", "letmein", "master", "dragon", "monkey", "secret", "token", "hello", "summer", "winter", "spring", "autumn", "user", "test", "guest", "root", "access", "love", "sunshine", "princess", "football", "the", "and", "your", "here", "example", "change", "none", "null", "true", "false", "value", "string", "key", "pass", "word", "for", "this", "that", "with", "from")
LEET = str.maketrans("@4310$5+7!", "aaeiosstti")
_MONTH, _DAY = r"(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12]\d|3[01])"
DATES = tuple(map(re.compile, (r"(?:19|20)\d\d", rf"(?:19|20)\d\d[-./]?{_MONTH}", rf"(?:19|20)\d\d[-./]?{_MONTH}[-./]?{_DAY}", rf"{_DAY}[-./]?{_MONTH}[-./]?(?:19|20)\d\d")))
SIGNS = frozenset("!@#$%^&*+=~?<>|\\")


def _alphabet(c: str) -> float:
    """log2 of the number of characters of a character's class."""
    return math.log2(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 1000)


@lru_cache(maxsize=4)
def _ranks(words: tuple[str, ...]) -> dict[str, float]:
    return {w: math.log2(i + 2) for i, w in enumerate(words)}


def _lowered(value: str) -> str:
    """Lower case, character by character, so that places stay the same."""
    return "".join(x if len(x := c.lower()) == 1 else c for c in value)


def guess_bits(value: str, words: tuple[str, ...] = COMMON, limit: float = math.inf) -> float:
    """log2 of the guesses for value: the least cost of cutting it into dictionary words (also
    in capitals or with digits for letters), dates, repeats, keyboard walks and brute-force
    spans. Dynamic programming over end positions: best[j] = min over i of best[i] + cost(i, j),
    for every span of every kind. A cut costs one bit, a brute-force span its characters'
    alphabets; a repeat costs its unit, cut in the best way, and its number. With a limit, the
    search ends where no cut can stay below it, with a number that isn't below it: what it
    looks at then depends on the limit, not on the value's length."""
    n, ranks, low = len(value), _ranks(words), _lowered(value)
    longest, plain = max(map(len, ranks), default=0), low.translate(LEET)
    best, far, runs = [0.0] + [math.inf] * n, 0, {}  # runs: where that of a unit's length and phase begins and ends

    def ends(j: int, cost: float) -> None:
        nonlocal far
        if cost < best[j]:
            best[j], far = cost, max(far, j)

    for i in range(n):
        if limit < math.inf and i % 8 == 0 and (least := min(best[i : max(far, i) + 1])) >= limit:
            return least
        here = best[i] + 1
        ends(i + 1, best[i] + _alphabet(value[i]))
        for text, extra in ((low, 0.0), (plain, 2.0)):
            for j in range(i + 3, min(n, i + longest) + 1):
                if (r := ranks.get(text[i:j])) is not None:
                    ends(j, here + r + extra + (value[i:j] != low[i:j]))
        for date in DATES if value[i].isdigit() else ():
            if m := date.match(value, i):
                ends(m.end(), here + 15.5)
        for row in WALKS:
            for step in (row, row[::-1]):
                at = step.find(low[i])
                j = i
                while 0 <= at < len(step) and j < n and low[j] == step[at]:
                    j, at = j + 1, at + 1
                    if j - i >= 3:
                        ends(j, here + math.log2(len(WALKS) * 2 * len(step)) + math.log2(j - i))
        u = value.find(value[i], i + 1) - i  # a unit can only end where its first character comes again
        while u > 0 and i + 2 * u <= n:
            end = i + 2 * u
            if value.startswith(value[i : i + u], i + u):
                start, end = runs.get((u, i % u), (i, 0))
                if not start < i < end or best[i] < best[start] + math.log2(1 + (i - start) / u / 2):  # else starting with the run is cheaper
                    unit, end = guess_bits(value[i : i + u], words, limit - here), i + 2 * u
                    if here + unit >= limit:
                        break
                    ends(end, here + unit + 1)
                    while value.startswith(value[i : i + u], end):
                        end += u
                        ends(end, here + unit + math.log2((end - i) // u))
                    runs[u, i % u] = (i, end)
            # Longer units that repeat within the same run are repeats of this one.
            u = value.find(value[i], max(i + u + 1, i + (end - i) // 2 + 1)) - i
    return best[n]


def _worth(value: str) -> bool:
    """Letters with digits, with two signs at least, or with capitals after small letters in two
    places: what prose after a keyword hardly is."""
    if not any(c.isalpha() for c in value):
        return False
    turns = sum(a.islower() and b.isupper() for a, b in zip(value, value[1:], strict=False))
    return any(c.isdigit() for c in value) or sum(c in SIGNS for c in value) >= 2 or turns >= 2


def find_spans(text: str, least_bits: float = 45.0, words: tuple[str, ...] = COMMON) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) by code points, end exclusive. Base matches of a kind are
    leftmost and don't overlap. A "guess" is a value of any length in a credential context that
    mixes letters with digits or signs and costs `least_bits` guesses or more, also where it is
    (or reaches beyond) an assigned value; one within an access or hex match isn't added."""
    low = text.lower()
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_VALUE] if any(k in low for k in ("passw", "secret", "token", "api")) else []
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS] if "AKIA" in text else []
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    fixed, guesses = [x for x in found if x[0] != "assign"], {}
    for m in itertools.chain(CONTEXT.finditer(text), ADDRESS.finditer(text) if "://" in text else ()):
        start = m.start(1)
        value = m[1].rstrip(".,;:!?)]}>") if m.re is CONTEXT else m[1]
        end = start + len(value)
        if end not in guesses and len(value) >= 8 and _worth(value) and not any(s <= start and end <= e for _, s, e in fixed) and guess_bits(value, words, least_bits) >= least_bits:
            guesses[end] = ("guess", start, end)
    return found + list(guesses.values())


def joined(spans: Iterable[tuple[str, int, int]]) -> str:
    """kind:start:end by start, then by kind as listed, joined by commas."""
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]))))


def scan(docs: DataFrame, least_bits: float = 45.0, words: tuple[str, ...] = COMMON, text_col: str = "text") -> DataFrame:
    """docs with a column secrets: an array of (kind, start, end, value) over the whole text.
    A null text counts as empty. Rows are independent, so there is no shuffle."""
    rest = [c for c in docs.columns if c != "secrets"]
    kind = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"

    @F.pandas_udf(kind)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"kind": k, "start": s, "end": e, "value": t[s:e]} for k, s, e in find_spans(t, least_bits, words)] for t in batch.fillna("")])

    return docs.select(*rest, spans(text_col).alias("secrets"))


def redacted(docs: DataFrame, mask: str = "[secret]", text_col: str = "text", **options) -> DataFrame:
    """docs with every secret's span replaced by mask; overlapping spans are replaced once. A null
    text stays null; rows are independent, repeated ones too; an empty table stays empty."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            if t is not None:
                end, parts = 0, []
                for _, s, e in sorted(find_spans(t, **options), key=lambda x: x[1:]):
                    parts += [t[end:s], mask] if s >= end else []
                    end = max(end, e)
                t = "".join([*parts, t[end:]])
            out.append(t)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text_col, clean(text_col))


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 (of the base spans) and spans (all spans)."""

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def digest(secrets: pd.Series) -> pd.DataFrame:
        rows = []
        for found in secrets:
            spans = [(x["kind"], x["start"], x["end"]) for x in found]
            base = [x for x in spans if x[0] != "guess"]
            rows.append([*(sum(k == x[0] for x in base) for k in KINDS[:3]), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)])
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return scan(docs.select("doc_id", "text"), **options).select("doc_id", digest("secrets").alias("d")).select("doc_id", "d.*")
