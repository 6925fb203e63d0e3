import hashlib
import random
import re
import string

import numpy as np
import pytest

from corvane.llm import secret_scan as S


def brute(t):
    out = []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out)


def test_base_patterns():
    rng = random.Random(4)
    parts = ["password", "Secret", "api_key", "APIKEY", "token", ":", "=", " ", "'", '"', "abcdefgh1", "short", "AKIA", "AKIA" + "Q7" * 8, "0123456789abcdef" * 2, "ſecret", "é", "x.y"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert S.base_spans(t) == brute(t), t


def test_the_battery_tells_random_from_words():
    rng = random.Random(1)
    random_ones = ["".join(rng.choices(string.ascii_letters + string.digits + "+/", k=40)) for _ in range(200)]
    texts = ["".join(rng.choices(["tion", "the", "er", "on", "an", "Re"], k=14))[:40] for _ in range(200)]
    low = int(S._bins(np.array([1e-4]))[0])
    assert (S._judged([(3, s.encode()) for s in random_ones]) >= low).sum() > 190
    assert (S._judged([(3, s.encode()) for s in texts]) >= low).sum() < 5
    assert [S.encoding_of(s) for s in ("0123", "deadBEEF", "dead01", "XYZ234", "aB+/", "a!", "")] == [0, 3, 1, 2, 3, None, None]


def test_scan_adds_random_strings_only(make):
    rng = random.Random(9)
    word = lambda: rng.choice(["thation", "onered", "inthe", "and", "Rely"])
    rows = [(i, " ".join(word() for _ in range(80))) for i in range(120)]
    key = "".join(rng.choices(string.ascii_letters + string.digits, k=48))
    rows += [(500 + i, f"see {''.join(rng.choices(string.ascii_letters + string.digits, k=48))} here") for i in range(20)]
    rows += [(900, f"password = {key}"), (901, None), (None, ""), (902, "x" * 200_000), (900, f"password = {key}")]
    out = S.scan_secrets(make(rows), rate=0.05).collect()
    assert len(out) == len(rows)
    found = {r.doc_id for r in out if "random" in r.spans}
    assert sum(i >= 500 for i in found if i is not None) >= 15 and not any(i is not None and i < 500 for i in found)
    assert {r.spans for r in out if r.doc_id == 900} == {f"assign:0:{11 + 48}"}
    assert S.scan_secrets(make([])).collect() == []


def test_a_value_after_its_name_is_a_candidate(make):
    rng = random.Random(12)
    draw = lambda n: "".join(rng.choices(string.ascii_letters + string.digits, k=n))
    key = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"
    spans = lambda t: [t[s:e] for s, e, *_ in S.candidates([t])[0]]
    assert spans(f"AWS_SECRET_ACCESS_KEY={key}") == [key] and spans(f"X={key}==;Y={key}=z") == [f"{key}==", key]
    short = "Ab3" * 6
    assert spans(f"v={short}== {short}=x {short} {short}==") == [f"{short}=="] * 2
    rows = [(i, " ".join(rng.choice(["thation", "onered", "inthe", "and", "Rely"]) for _ in range(80))) for i in range(120)]
    rows += [(500 + i, f"{name}={draw(48)}") for i, name in enumerate(["AWS_ACCESS", "DB_PASS", "https://a.net/x?sig", "Key_Of_The_Production_Server"] * 5)]
    out = S.scan_secrets(make(rows), rate=0.05).collect()
    found = {r.doc_id for r in out if "random" in r.spans}
    assert sum(i >= 500 for i in found) >= 15 and not any(i < 500 for i in found)
    assert all(not r.base_spans for r in out)


@pytest.mark.parametrize("k, n", [(10, 20), (16, 24), (32, 20), (64, 20), (64, 40), (64, 100), (64, 400), (10, 80)])
def test_uniformity_is_a_p_value(k, n):
    counts = np.array([np.bincount(row, minlength=k) for row in np.random.default_rng(n).integers(0, k, (4000, n))])
    p = S.uniformity(((counts - n / k) ** 2).sum(axis=1) * k / n, k, n)
    for level in (0.5, 0.1, 0.01):
        assert (p <= level).mean() <= 1.6 * level + 0.002
    assert (p <= 0.5).mean() > 0.25
    beyond = S.uniformity(np.linspace(2 * k, k * n, 500), k, n)
    assert (np.diff(beyond[beyond < 0.5]) <= 1e-12).all()


def test_the_battery_row_by_row():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 32, (50, 33))
    rows[3], rows[4] = 7, np.arange(33) % 32
    whole = S.battery(rows, 32)
    assert np.allclose(whole, [S.battery(r[None, :], 32)[0] for r in rows]) and whole[3] < 1e-20 and ((0 <= whole) & (whole <= 1)).all()


#: Strings of each encoding that nobody drew at random.
PLAIN = {
    0: ["12345678901234567890", "20261126144912345678", "00000000000000000001", "19991231235959000000", "11112222333344445555"],
    1: ["deadbeefdeadbeefdead", "00112233445566778899aa", "facadefacadefacade00", "0123456789abcdef0123", "cafe0000cafe0001cafe"],
    2: ["THEQUICKBROWNFOX2JUMPSOVER", "PLEASE7READ2THE4MANUAL", "SECTION2CHAPTER3PAGE4TEXT", "ABCDEFGHIJKLMNOPQRST234567", "ORDER2ITEMS3BOXES4PIECES"],
    3: ["InternationalizationOfSoftware2026Edition", "getElementsByClassName01Value", "TheOldManAndTheSea1952FirstEdition", "MaximumNumberOfConnections100", "path/to/The/Folder/With/Names/01"],
}
DRAWN = {0: (string.digits, 40), 1: ("0123456789abcdef", 30), 2: ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 40), 3: (string.ascii_letters + string.digits + "+/", 40)}


def prose(rng, n, numbers):
    words = "the of section and number seven order in chapter page total item report which from letter price house street year".split()
    return " ".join(rng.choice(words) if rng.random() >= numbers else rng.choice([f"{rng.randrange(1900, 2030)}", f"{rng.randrange(10**5)}", f"{rng.randrange(100)}", f"2026-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}", f"{rng.randrange(24)}:{rng.randrange(60):02}"]) for _ in range(n))


@pytest.mark.parametrize("encoding", [0, 1, 2, 3])
def test_plain_strings_of_each_encoding_are_no_discoveries(make, encoding):
    rng, numbers = random.Random(encoding), 0.05 if encoding else 0.2
    plain = PLAIN[encoding]
    assert all(S.encoding_of(s) == encoding for s in plain)
    rows = [(i, f"{prose(rng, 260, numbers)} {plain[i % len(plain)]} {prose(rng, 20, numbers)}") for i in range(300)]
    alphabet, n = DRAWN[encoding]
    keys = ["".join(rng.choices(alphabet, k=n)) for _ in range(60)]
    rows += [(1000 + i, f"{prose(rng, 200, numbers)} {key} {prose(rng, 40, numbers)}") for i, key in enumerate(keys)]
    out = S.scan_secrets(make(rows), rate=0.05).collect()
    found = {r.doc_id for r in out if "random" in r.spans}
    false, right = sum(i < 1000 for i in found), sum(i >= 1000 for i in found)
    assert false <= 0.1 * max(1, len(found)), sorted({plain[i % len(plain)] for i in found if i < 1000})
    assert right >= (15 if encoding else 0)


def test_the_query_columns(spark, sf_dir):
    from corvane.llm import queries

    texts = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    for r in queries.op7_secret_scan(spark, sf_dir).collect():
        want = brute(texts[r.doc_id] or "")
        listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in want) for i in range(3))
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and set(filter(None, listed.split(","))) <= set(r.spans.split(","))
