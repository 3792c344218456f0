import base64
import hashlib
import json
import random
import re
import time

import pytest

from strandsieve.llm import secrets

BASE = {
    "assign": (r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A, lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 24),
}


def plain(text):
    return sorted((m.start(), k, m.end()) for k, (e, flags, holds) in enumerate(BASE.values()) for m in re.finditer(e, text, flags) if holds(m))


def tlv(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    size = bytes([n]) if n < 128 else (lambda b: bytes([0x80 | len(b)]) + b)(n.to_bytes((n.bit_length() + 7) // 8, "big"))
    return bytes([tag]) + size + body


def number(x):
    return tlv(2, x.to_bytes(x.bit_length() // 8 + 1, "big"))


rng = random.Random(11)
RSA_OID, ED_OID, P256 = bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2b6570"), bytes.fromhex("2a8648ce3d030107")
PKCS1 = tlv(0x30, number(0), *[number(rng.getrandbits(n)) for n in (1024, 17, 1024, 512, 512, 512, 512, 512)])
PKCS8 = tlv(0x30, number(0), tlv(0x30, tlv(6, RSA_OID), tlv(5)), tlv(4, PKCS1))
ED25519 = tlv(0x30, number(0), tlv(0x30, tlv(6, ED_OID)), tlv(4, tlv(4, rng.randbytes(32))))
SEC1 = tlv(0x30, number(1), tlv(4, rng.randbytes(32)), tlv(0xA0, tlv(6, P256)), tlv(0xA1, tlv(3, b"\0" + rng.randbytes(65))))
SEALED = tlv(0x30, tlv(0x30, tlv(6, bytes.fromhex("2a864886f70d01050d")), tlv(0x30, tlv(4, b"12345678"))), tlv(4, rng.randbytes(64)))
PFX = tlv(0x30, number(3), tlv(0x30, tlv(6, bytes.fromhex("2a864886f70d010701")), tlv(0xA0, tlv(4, rng.randbytes(90)))))
DSA = tlv(0x30, number(0), *[number(rng.getrandbits(n)) for n in (512, 160, 512, 512, 160)])
PUBLIC = tlv(0x30, tlv(0x30, tlv(6, RSA_OID), tlv(5)), tlv(3, b"\0" + rng.randbytes(140)))


def ssh_string(b):
    return len(b).to_bytes(4, "big") + b


OPENSSH = b"openssh-key-v1\0" + ssh_string(b"none") + ssh_string(b"none") + ssh_string(b"") + (1).to_bytes(4, "big") + ssh_string(b"public part") + ssh_string(b"abcdabcd" + rng.randbytes(64))
KEYS = {"pkcs1": PKCS1, "pkcs8": PKCS8, "sec1": SEC1, "encrypted pkcs8": SEALED, "pkcs12": PFX, "dsa": DSA, "openssh": OPENSSH}


def b64(data, width=0):
    text = base64.b64encode(data).decode()
    return text if not width else "\n".join(text[i : i + width] for i in range(0, len(text), width))


def url(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def jwt(alg="HS256", signature=32, payload=b'{"sub":"1"}', header=None):
    return ".".join((url(header if header is not None else json.dumps({"typ": "JWT", "alg": alg}).encode()), url(payload), url(rng.randbytes(signature))))


def spans(text):
    return [(text[s:e], secrets.KINDS[k], form) for s, k, e, form in secrets.structures(text)]


def test_base_spans_are_those_of_the_plain_expressions():
    fixed = [
        'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" x', "PassWord:'hunter22'", "api_key==abc=def", "apikey : abcde", "secret=token=abcdef", "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 15, "AKIAB AKIA" + "0" * 30,
        "ſecret=abcdefg toKen=abcdefg", "a" * 23, "a" * 24, "x" + "0" * 60 + "g" + "f" * 30, "token\" \"= abcdefgh", "token=\"'abcdefgh", "password=" + "a" * 5 + " " + "b" * 9, "",
    ]
    pieces = ["token", "Secret", "api_key", "apikey", "passwd", "password", "=", ":", " ", '"', "'", "AKIA", "abcdef0123", "ABCDEFGH12", ".", "-", "é", "\n"]
    for text in fixed + ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(5000)]:
        assert secrets.base_spans(text) == plain(text), text


@pytest.mark.parametrize("form", KEYS)
def test_keys_are_confirmed_in_every_wrapping(form):
    key = KEYS[form]
    label = {"pkcs1": "RSA PRIVATE KEY", "openssh": "OPENSSH PRIVATE KEY", "sec1": "EC PRIVATE KEY", "dsa": "DSA PRIVATE KEY", "encrypted pkcs8": "ENCRYPTED PRIVATE KEY"}.get(form, "PRIVATE KEY")
    pem = f"-----BEGIN {label}-----\n{b64(key, 64)}\n-----END {label}-----"
    assert spans(f"é here: {pem} and on") == [(pem, "key", form)]
    escaped = pem.replace("\n", "\\n")
    assert spans(f'"k": "{escaped}"') == [(escaped, "key", form)]
    for body in (b64(key), b64(key, 76), key.hex(), key.hex().upper()):
        assert spans(f"before {body} after") == [(body, "key", form)]
    assert spans(f"x {url(key)} y") == [(url(key), "key", form)]
    wrapped = b64(pem.encode())
    assert spans(f"data: {wrapped}\nmore") == [(wrapped, "key", f"encoded {form}")]


def test_a_key_among_other_lines_is_cut_out_by_its_length():
    text = f"introduction\n{b64(ED25519, 32)}\nwordsThatFollowOnTheNextLine\nandMore"
    assert spans(text) == [(b64(ED25519, 32), "key", "pkcs8")]


def test_broken_structures_are_not_reported():
    for key in KEYS.values():
        longer, shorter = key + b"\0", key[:-1]
        flipped = bytes([key[0]]) + bytes([key[1] ^ 1]) + key[2:]
        for bad in (longer, shorter, flipped):
            assert secrets.binary_key(bad) is None
            assert spans(f"-----BEGIN PRIVATE KEY-----\n{b64(bad, 64)}\n-----END PRIVATE KEY-----") == []
    for text in (b64(PUBLIC), PUBLIC.hex(), b64(b"an ordinary sentence that was encoded for no reason"), "Donaudampfschifffahrtsgesellschaft", "0" * 64, "-----BEGIN PRIVATE KEY-----"):
        assert spans(text) == [], text
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{b64(PKCS1, 64)}\n-----END EC PRIVATE KEY-----"
    assert spans(pem) == [(b64(PKCS1, 64), "key", "pkcs1")]


def test_old_encrypted_pem_is_judged_by_its_headers():
    body = b64(rng.randbytes(96), 64)
    pem = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{}\n\n" + body + "\n-----END RSA PRIVATE KEY-----"
    assert spans(pem.format("0F" * 16)) == [(pem.format("0F" * 16), "key", "encrypted pem")]
    assert spans(pem.format("0F" * 15)) == []


def test_signed_tokens():
    for alg, n in (("HS256", 32), ("HS512", 64), ("RS256", 256), ("ES256", 64), ("EdDSA", 64), ("none", 0)):
        token = jwt(alg, n)
        assert spans(f"Bearer {token}. Then") == [(token, "signed", alg)], alg
    odd = jwt(header=b' { "alg" : "HS256" }')
    assert spans(odd) == [(odd, "signed", "HS256")]
    for bad in (jwt("HS256", 31), jwt("XX", 32), jwt(payload=b"[1]"), jwt(header=b'{"typ":"JWT"}'), jwt(header=b"[1, 2, 3, 4, 5, 6]"), "a" * 20 + ".bbbb.cccc", jwt() + ".x" * 2):
        assert spans(bad) == [], bad
    nested = b64(f"authorization {jwt()}".encode())
    assert spans(nested) == [(nested, "key", "encoded HS256")]


def test_time_is_in_proportion_to_the_text():
    texts = ["MII" * 100_000, "MIIE\n" * 60_000, "-----BEGIN PRIVATE KEY-----" * 10_000, "ab" * 200_000, "a." * 150_000, "a" * 20 + ".aaaa" * 60_000, "token = " * 40_000, "=" * 300_000, b64(OPENSSH[:60]) * 4_000, "password" + " " * 300_000, "AKIA" * 80_000]
    for text in texts:
        began = time.process_time()
        secrets.base_spans(text)
        secrets.structures(text)
        assert time.process_time() - began < 5, text[:40]


def test_contract_columns(make):
    token = jwt()
    text = f'é token = "{token}" and AKIA{"Q7" * 8} or {"0a" * 20}, key:\n{b64(ED25519)}'
    r = {r.doc_id: r for r in secrets.find_secrets(make((1, text), (2, None), (3, "nothing"))).collect()}
    base = secrets.shown(plain(text))
    assert (r[1].n_assign, r[1].n_access, r[1].n_hex, r[1].n_found) == (1, 1, 1, 2)
    assert r[1].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert set(base.split(",")) < set(r[1].spans.split(","))
    assert [(f.kind, text[f.start : f.end], f.form) for f in r[1].found] == [("signed", token, "HS256"), ("key", b64(ED25519), "pkcs8")]
    assert r[1].spans == ",".join(sorted(r[1].spans.split(","), key=lambda s: (int(s.split(":")[1]), secrets.KINDS.index(s.split(":")[0]))))
    assert (r[2].spans, r[2].base_sha256, r[3].n_found) == ("", hashlib.sha256(b"").hexdigest(), 0)


def test_masking_takes_out_every_span(make):
    got = {r.doc_id: r.text for r in secrets.masked(make((1, f"a token={'x' * 8} b {b64(ED25519)} c"), (2, None), (3, "as it was"))).collect()}
    assert got == {1: "a <secret> b <secret> c", 2: None, 3: "as it was"}


def test_edge_cases(nasty, empty):
    got = secrets.find_secrets(nasty)
    assert got.count() == nasty.count()
    assert all(r.spans == "" for r in got.where("length(spans) < 3").collect())
    assert secrets.find_secrets(empty).count() == 0
    assert secrets.masked(nasty).columns == nasty.columns
    assert secrets.masked(nasty).count() == nasty.count()
