import functools
import hashlib
import math
import random
import re
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.secrets import LEET, WALKS, find_spans, guess_bits, joined, redacted, scan, secret_report

SAFE = set(string.ascii_letters + string.digits + "+/_.=-")


def brute_base(t):
    """The base kinds by plain scanning, without regular expressions."""
    out, i = [], 0
    while i < len(t):
        for key in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if t[i : i + len(key)].isascii() and t[i : i + len(key)].lower() == key:
                j = i + len(key)
                j += t[j : j + 1] in ('"', "'") and j < len(t)
                while t[j : j + 1] == " ":
                    j += 1
                if t[j : j + 1] not in (":", "="):
                    continue
                j += 1
                while t[j : j + 1] == " ":
                    j += 1
                j += t[j : j + 1] in ('"', "'") and j < len(t)
                e = j
                while e < len(t) and t[e] in SAFE:
                    e += 1
                if e > j:
                    if e - j >= 6:
                        out.append(("assign", i, e))
                    i = e - 1
                    break
        i += 1
    for kind, head, allowed, least in (("access", "AKIA", string.ascii_uppercase + string.digits, 20), ("hex", "", string.digits + "abcdef", 24)):
        i = 0
        while i < len(t):
            e = i + len(head)
            if t.startswith(head, i):
                while e < len(t) and t[e] in allowed:
                    e += 1
                if e > i + len(head):
                    if e - i >= least:
                        out.append((kind, i, e))
                    i = e - 1
            i += 1
    return joined(out)


PARTS = st.sampled_from(["password", "PassWd", "token", "api_key", "APIKEY", "secret", "=", ":", " = ", '"', "'", " ", "abc123", "x" * 7, "AKIA", "AKIA" + "Z9" * 9, "0a" * 12, "deadbeef", "é", "ſecret", "toKen", "\n", "=="])


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=12).map("".join))
def test_base_spans_against_plain_scanning(text):
    assert joined(x for x in find_spans(text) if x[0] != "guess") == brute_base(text)


def test_guess_costs():
    assert guess_bits("") == 0
    assert guess_bits("password") < guess_bits("p4ssw0rd") < guess_bits("xkqvbzrj")
    assert guess_bits("qwertyui") < 12 and guess_bits("aaaaaaaaaaaa") < 12 and guess_bits("1999-12-31") < 18
    assert guess_bits("abcabcabcabc") < guess_bits("abcxyqnrtwpv")
    assert guess_bits("k3J9xQ2mZ7pL4v") > 45


def test_cuts_into_words_against_all_cuts():
    """Texts of different letters without keyboard walks: only words and single characters are left."""
    words = ("cat", "atm", "tmz", "catxb", "mzx", "bca")
    rank = {w: math.log2(i + 2) for i, w in enumerate(words)}
    rng = random.Random(6)
    for _ in range(500):
        v = "".join(rng.sample("catmzxbw", rng.randint(1, 8)))
        if any(v[i : i + 3] in row or v[i : i + 3] in row[::-1] for row in WALKS for i in range(len(v) - 2)):
            continue

        def cheapest(at, v=v):
            if at == len(v):
                return 0.0
            return min([math.log2(26) + cheapest(at + 1)] + [1 + rank[w] + cheapest(at + len(w)) for w in words if v.startswith(w, at)])

        assert guess_bits(v, words) == pytest.approx(cheapest(0))


def spans_of_all_kinds(v, words):
    """Costs of all spans (i, j) of v, by trying every one."""
    rank, low = {w: math.log2(i + 2) for i, w in enumerate(words)}, v.lower()
    plain = low.translate(LEET)
    cost = {}

    def least(i, j, x):
        cost[i, j] = min(cost.get((i, j), math.inf), x)

    for i in range(len(v)):
        least(i, i + 1, math.log2(10 if v[i].isdigit() else 26 if v[i].isalpha() and v[i].isascii() else 33 if v[i].isascii() else 1000))
        for j in range(i + 1, len(v) + 1):
            if j - i >= 3:
                for t, extra in ((low, 0), (plain, 2)):
                    if t[i:j] in rank:
                        least(i, j, 1 + rank[t[i:j]] + extra + (v[i:j] != low[i:j]))
                for row in WALKS:
                    if low[i:j] in row or low[i:j] in row[::-1]:
                        least(i, j, 1 + math.log2(2 * len(WALKS) * len(row)) + math.log2(j - i))
            if re.fullmatch(r"(?:19|20)\d\d([-./]?(0[1-9]|1[0-2])([-./]?(0[1-9]|[12]\d|3[01]))?)?|(0[1-9]|[12]\d|3[01])[-./]?(0[1-9]|1[0-2])[-./]?(19|20)\d\d", v[i:j]):
                least(i, j, 1 + 15.5)
            for u in range(1, (j - i) // 2 + 1):
                if (j - i) % u == 0 and v[i : i + u] * ((j - i) // u) == v[i:j]:
                    least(i, j, 1 + cheapest(v[i : i + u], words) + math.log2((j - i) // u))
    return cost


@functools.lru_cache(None)
def cheapest(v, words):
    cost, best = spans_of_all_kinds(v, words), [0.0] + [math.inf] * len(v)
    for j in range(1, len(v) + 1):
        best[j] = min(best[i] + cost[i, j] for i in range(j) if (i, j) in cost)
    return best[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "aab", "1", "19", "20", "-", "12", "2024-01-31", "311299", "qwe", "4321", "cat", "C4T", "xyz", "é", "$"]), max_size=7).map("".join))
def test_guess_costs_against_all_cuts_of_all_kinds(v):
    words = ("cat", "bcat", "aba")
    assert guess_bits(v, words) == pytest.approx(cheapest(v, words))
    for limit in (5.0, 20.0, 45.0):
        assert (guess_bits(v, words, limit) >= limit) == (cheapest(v, words) >= limit)


def test_guess_costs_of_repeats_and_long_values():
    assert guess_bits("aabaab") < guess_bits("aab") + 3 and guess_bits("İAB12345678") > 20
    assert guess_bits("ab" * 50_000 + "1", limit=45.0) < 45 <= guess_bits("k3J9xQ2mZ7pL4v" * 10_000, limit=45.0)


def test_context_values_add_spans():
    text = "login Summer2024 and the passphrase k3J9xQ2mZ7pL4v, token=abcdef1"
    assert joined(find_spans(text)) == f"guess:{text.index('k3J9')}:{text.index(', token')},assign:{text.index('token')}:{len(text)}"


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("Authorization: Bearer " + "k3J9xQ2mZ7pL4v" * 30 + ".", "k3J9xQ2mZ7pL4v" * 30),
        ("passphrase xK$Qv!brZ#pLw&mN", "xK$Qv!brZ#pLw&mN"),
        ("login password: v@7$kLw0rD9xxQ7", "v@7$kLw0rD9xxQ7"),
        ("the secret passphrase is k3J9xQ2mZ7pL4v", "k3J9xQ2mZ7pL4v"),
        ("password: Tr0ub4dor&3xyz!Q", "Tr0ub4dor&3xyz!Q"),
        ("api_key=k3J9xQ2mZ7pL4v", "k3J9xQ2mZ7pL4v"),
        ("token distribution-network of the password resetting", None),
    ],
)
def test_values_of_credential_contexts(text, value):
    got = [text[s:e] for k, s, e in find_spans(text) if k == "guess"]
    assert got == ([] if value is None else [value])


def test_report_nulls_long_and_clashing_columns(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "é password=abcdefg", "x"), (3, "é password=abcdefg", "x"), (4, "w " * 60_000 + "AKIA" + "A1" * 10, "x"), (None, "api_key: '123'", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, secrets string")
    got = secret_report(df).collect()
    want = [(i, brute_base(t or "")) for i, t, _ in rows]
    assert [(r.doc_id, r.spans, r.base_sha256) for r in got] == [(i, b, hashlib.sha256(b.encode()).hexdigest()) for i, b in want]
    assert scan(df).columns == ["doc_id", "text", "secrets"]
    assert secret_report(df.limit(0)).count() == 0
    assert redacted(df).where("doc_id = 3").first().text == "é [secret]"


def test_values_of_letters_names_around_keywords_and_addresses():
    found = lambda t: [t[s:e] for k, s, e in find_spans(t) if k == "guess"]
    assert found("password: zQvxkjwpLmTrBghsNc") == ["zQvxkjwpLmTrBghsNc"]
    assert found("AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMIK7MDENGbPxRfiCY") == ["wJalrXUtnFEMIK7MDENGbPxRfiCY"]
    assert found("see mysql://root:tR9vQx2LmPz@host/db") == ["tR9vQx2LmPz"]
    for clean in ("Password: Extraordinary things", "the secret is Constantinople", "https://example.org:8080/a@b", "token: JavaScript", "http://a:b@c"):
        assert found(clean) == []
