import base64
import hashlib
import json
import random
import re

import duckdb

from quire.llm import catalog, secrets
SF = "/root/testdata/sf0.01"


def base_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 8:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m.group()) >= 16:
            out.append((m.start(), 1, f"access:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m.group()) >= 32:
            out.append((m.start(), 2, f"hex:{m.start()}:{m.end()}"))
    return sorted(out)


def row(doc_id, text):
    spans = base_spans(text)
    return (doc_id, *(sum(s[1] == k for s in spans) for k in range(3)), hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest())


def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")) + body


rng = random.Random(15)
integer = lambda n: der(2, bytes([rng.randrange(1, 128)]) + rng.randbytes(n - 1))
RSA = der(0x30, der(2, b"\0"), *(integer(n) for n in (128, 3, 128, 64, 64, 64, 64, 64)))
EC = der(0x30, der(2, b"\1"), der(4, rng.randbytes(32)), der(0xA0, der(6, b"\x2a\x86\x48")), der(0xA1, der(3, rng.randbytes(66))))
PKCS8 = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48\x86"), der(5)), der(4, RSA))
field = lambda b: len(b).to_bytes(4, "big") + b
OPENSSH = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(rng.randbytes(51)) + field(rng.randbytes(140))


def jwt(alg, size, header=None):
    seg = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
    return ".".join([seg(json.dumps(header or {"alg": alg, "typ": "JWT"}).encode()), seg(json.dumps({"sub": "1"}).encode()), seg(rng.randbytes(size))])


def pem(data):
    text = base64.b64encode(data).decode()
    return "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(text[i : i + 64] for i in range(0, len(text), 64)) + "\n-----END RSA PRIVATE KEY-----"


def test_query_equals_brute_force(spark):
    texts = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    got = [tuple(r) for r in catalog.op2_secrets(spark, SF).collect()]
    assert sorted(r[:-1] for r in got) == sorted(row(d, t) for d, t in texts)
    said = {d: [s[2] for s in base_spans(t)] for d, t in texts}
    assert all(set(said[r[0]]) <= set(r[-1].split(",")) or not said[r[0]] for r in got) and any(said.values())


def test_structures_are_confirmed():
    for data in (RSA, EC, PKCS8, OPENSSH):
        for text in (pem(data), base64.b64encode(data).decode(), data.hex(), data.hex().upper()):
            kinds = [(k, a, b) for k, a, b in secrets.scan("key: " + text + " end.") if k == "private_key"]
            assert kinds and kinds[0][1] == 5 and kinds[0][2] >= 5 + len(text.rstrip("=")), (data[:4], text[:40])
    for alg, size in (("HS256", 32), ("ES384", 96), ("RS256", 256), ("EdDSA", 64)):
        assert [k for k, _, _ in secrets.scan(f"see {jwt(alg, size)}.") if k == "jwt"] == ["jwt"]


def test_unstructured_candidates_are_not_reported():
    flat = rng.randbytes(200)
    wrong = [RSA[:-1], RSA + b"\0", der(0x30, der(2, b"\0"), integer(64)), der(0x31, RSA[4:]), OPENSSH[:-3], flat, der(0x30, der(2, b"\5"), der(4, flat))]
    for data in wrong:
        for text in (pem(data), base64.b64encode(data).decode(), data.hex()):
            assert not [s for s in secrets.scan(text) if s[0] == "private_key"], data[:8]
    for text in (jwt("HS256", 31), jwt("none", 0), jwt("", 10, {"typ": "JWT"}), jwt("HS256", 32)[:-60], "eyJhbGciOiJIUzI1NiJ9.eyJub3Q.abc"):
        assert not [s for s in secrets.scan(text) if s[0] == "jwt"], text


def test_odd_rows(spark):
    bits = ["token", "TOKEN=", "secret : ", "api_key", "apikey\"='", "abcdefgh", "x", " ", "=", ":", "'", "ſecret=", "AKIA", "AKIAABCDEFGH1234", "0af9" * 9, "deadbeef", "ä😀", "\n", "pass" "word=", "a.b-c/d+e_f="]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(20))) for _ in range(600)] + [None, "", "f" * 100001, "token=" * 5000, "AKIA" * 9000, pem(RSA) * 3]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, spans string")
    out = secrets.scan_documents(df)
    assert out.columns == ["doc_id", "spans"]
    for r in out.collect():
        t = texts[r.doc_id]
        assert [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind in secrets.BASE_KINDS] == [s[2] for s in base_spans(t)], repr(t)[:200]
        assert [tuple(s) for s in r.spans] == secrets.scan(t)
    assert secrets.scan_documents(df.limit(0)).count() == 0


DSA = der(0x30, der(2, b"\0"), *(integer(n) for n in (128, 20, 128, 128, 20)))
ENCRYPTED = der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")), der(0x30, der(4, rng.randbytes(8)))), der(4, rng.randbytes(640)))
B64 = lambda b: base64.b64encode(b).decode()


def keys_of(text):
    return [(a, b) for k, a, b in secrets.scan(text) if k == "private_key"]


def test_candidates_are_decoded_wherever_they_stand():
    """Each form and, with one byte less, its corrupted twin."""
    wrapped = lambda b, gap: gap.join(B64(b)[i : i + 64] for i in range(0, len(B64(b)), 64))
    forms = {
        "whole PEM text": lambda k: B64(pem(k).encode()),
        "PEM text within others": lambda k: B64(b"a: 1\n" + pem(k).encode() + b"\nb: 2\n"),
        "after a path": lambda k: "url/" + B64(k),
        "after letters": lambda k: "Key9" + B64(k),
        "lines": lambda k: wrapped(k, "\n"),
        "indented lines": lambda k: "data: " + wrapped(k, "\r\n  ") + "\nEnd of it",
        "written line ends": lambda k: '"' + wrapped(k, "\\n") + '\\n"',
        "hex after digits": lambda k: "00" + k.hex(),
        "PEM": pem,
    }
    for key in (RSA, DSA, EC, PKCS8, ENCRYPTED, OPENSSH):
        for name, form in forms.items():
            text = "x = " + form(key) + " ."
            assert len(keys_of(text)) == 1, (name, key[:6])
            a, b = keys_of(text)[0]
            body = re.sub(r"\\n|\s", "", text[a:b])
            assert a >= 4 and (name.startswith("PEM") or "whole" in name or B64(key) == body or key.hex() == body), name
            assert not keys_of("x = " + form(key[:-1]) + " ."), (name, key[:6])
    digest_info = der(0x30, der(0x30, der(6, bytes.fromhex("608648016503040201")), der(5)), der(4, rng.randbytes(200)))
    assert not keys_of(B64(digest_info)) and not keys_of(digest_info.hex())


def test_tokens_with_blanks_and_neighbours():
    seg = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
    for head, body in ((b'{ "alg": "HS256"}', b'{ "sub": 1}'), (b'\n{"alg":"HS256"}', b' {}'), (b'{"alg":"HS256"}', b"{\n}")):
        token = f"{seg(head)}.{seg(body)}.{seg(rng.randbytes(32))}"
        for before in ("", "www.example.", "Bearer-", "a.b.c.d."):
            found = [(a, b) for k, a, b in secrets.scan(f"{before}{token} x") if k == "jwt"]
            assert found == [(len(before), len(before) + len(token))], (before, head)
            assert not [k for k, _, _ in secrets.scan(f"{before}{token[:-2]} x") if k == "jwt"]


def test_long_texts_without_keys_take_little():
    """Runs that look like keys at many places."""
    import time

    t0 = time.time()
    for text in ("MII" * 300000, "MIIB" * 200000, "3082" * 200000, "30" * 400000, "eyJ" * 200000, "eyJh." * 100000, "a." * 400000, (pem(RSA[:-1]) + "\n") * 300, "LS0t" * 200000, "b3BlbnNzaC1rZXktdjEA" * 20000):
        assert not [s for s in secrets.scan(text) if s[0] in ("private_key",)], text[:9]
    assert time.time() - t0 < 60
    assert len(keys_of((pem(RSA) + "\n") * 400)) == 400
