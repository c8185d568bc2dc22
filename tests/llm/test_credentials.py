"""Secret scans against plain regular expressions over code points, with tokens whose checksums hold or do not."""

import random
import re
import zlib

from cases import TEXTS, empty, frame
from test_documents import ordered, whole

from tarifa.llm import credentials, queries

PAYLOAD = "abcdefghijKLMNOPQRST0123456789"
# The published test vector of the checksum's authors has another prefix, so a token is built from the definition.
BECH32 = credentials.BECH32.decode()


def crc_token(prefix, payload=PAYLOAD):
    value, digits = zlib.crc32(payload.encode()), ""
    for _ in range(6):
        digits = credentials.BASE62.decode()[value % 62] + digits
        value //= 62
    return prefix + payload + digits


def polymod(values):
    total = 1
    for value in values:
        top, total = total >> 25, (total & 0x1FFFFFF) << 5 ^ value
        for i in range(5):
            total ^= credentials.BECH32_GENERATORS[i] if top >> i & 1 else 0
    return total


def bech32_token(prefix, data):
    values = [*(ord(c) >> 5 for c in prefix), 0, *(ord(c) & 31 for c in prefix), *data]
    check = polymod([*values, 0, 0, 0, 0, 0, 0]) ^ 1
    return prefix + "1" + "".join(BECH32[v] for v in [*data, *(check >> 5 * (5 - i) & 31 for i in range(6))])


def expected(text):
    """``finditer`` of the contract's expressions over code points, and of the two added forms."""
    keyword = "".join
    either = keyword(["(", "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in (
        "password", "passwd", "secret", "token", "api_key", "apikey")), ")"])
    assign = either + "[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    valid = {
        "github": lambda m: len(m) == 40 and m == crc_token(m[:4], m[4:34]),
        "npm": lambda m: len(m) == 40 and m == crc_token(m[:4], m[4:34]),
        "age": lambda m: len(m) == 74 and set(m[16:].lower()) <= set(BECH32)
        and m.lower() == bech32_token("age-secret-key-", [BECH32.index(c) for c in m[16:68].lower()]),
    }
    spans = []
    for number, (kind, pattern, group, least) in enumerate([
        ("assign", assign, 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32),
        ("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40), ("npm", "npm_[A-Za-z0-9]+", 0, 40),
        ("age", "AGE-SECRET-KEY-1[A-Z0-9]+", 0, 74),
    ]):
        for m in re.finditer(pattern, text or ""):
            if len(m[group]) >= least and valid.get(kind, lambda _: True)(m[0]):
                spans.append((m.start(), number, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def found(df):
    return ordered((r["doc_id"], [tuple(s) for s in r["secrets"]]) for r in df.collect())


def pieces(rng):
    parts = ["password", "Token", "passwd", "SECRET", "api_key", "apiKEY", "=", " = ", ":", "'", '"', "AKIA", "ABCDEFGH12345678", "é",
             "deadbeef" * 4, "0123456789abcdef", "漢", "x", " ", "\n", "=abc", "ffff", "ſecret", crc_token("ghp_"), crc_token("npm_"),
             crc_token("gho_")[:-1] + "x", "b" * 3000, bech32_token("age-secret-key-", range(26)).upper(),
             bech32_token("age-secret-key-", [*range(31, -1, -1), *range(20)]).upper()]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(30)))


def test_against_expressions(spark, folder):
    rng = random.Random(12)
    made = [(i, pieces(rng)) for i in range(600)] + [(5000, "token=" + "7" * 300_000 + " " + "a1" * 100_000)]
    for texts in (TEXTS, made, whole(spark, folder)):
        df = credentials.scan(frame(spark, texts))
        assert df.columns[-1] == "secrets"
        assert found(df) == ordered((i, expected(t)) for i, t in texts)
    assert sum(len(expected(t)) for _, t in made) > 500
    assert {k for _, t in made for k, _, _ in expected(t)} == {k.name for k in credentials.KINDS}
    assert credentials.scan(empty(spark)).count() == 0


def test_keywords_across_chunks():
    text = (b"x" * 11 + b"Password: 12345678 ") * 5
    whole_starts = credentials.keyword_starts(text, credentials.KINDS)
    assert all(credentials.keyword_starts(text, credentials.KINDS, n) == whole_starts for n in range(1, 40))


def test_checksums():
    good = crc_token("ghs_").encode()
    assert credentials.has_crc(good) and not credentials.has_crc(good[:-1] + b"0") and not credentials.has_crc(good + b"0")
    key = bech32_token("age-secret-key-", [7] * 52).upper().encode()
    assert credentials.has_bech32(key) and not credentials.has_bech32(key[:-1] + b"B") and not credentials.has_bech32(b"1")


def test_masked_and_clashing_columns(spark):
    text = f"é token=abcdefgh{'0' * 32} end {crc_token('ghp_')}"
    rows = spark.createDataFrame([(1, text, 5), (2, None, 6)], "doc_id long, text string, secrets int")
    masked = {r["doc_id"]: (r["text"], len(r["secrets"])) for r in credentials.scan(rows, mask="#").collect()}
    assert masked == {1: ("é # end #", 3), 2: (None, 0)}


def test_query_digests(spark, folder):
    import hashlib

    rows = {r["doc_id"]: r for r in queries.QUERIES["op12_secret_scan"](spark, folder).collect()}
    listed = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    for i, text in whole(spark, folder):
        own = expected(text)
        base = [s for s in own if s[0] in ("assign", "access", "hex")]
        counts = [sum(k == name for k, _, _ in base) for name in ("assign", "access", "hex")]
        assert [rows[i]["n_assign"], rows[i]["n_access"], rows[i]["n_hex"]] == counts and rows[i]["spans"] == listed(own)
        assert rows[i]["base_sha256"] == hashlib.sha256(listed(base).encode()).hexdigest()
