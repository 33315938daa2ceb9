import base64
import json
import random
import re
import time

import pytest

from pagestrata.llm import secret_structure as ss


def der(tag, body):
    n = len(body)
    head = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + head + body


RNG = random.Random(11)
KEY = der(0x30, der(2, b"\0") + b"".join(der(2, b"\x01" + RNG.randbytes(n)) for n in (128, 3, 127, 64, 64)))
SSH = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-ed25519", RNG.randbytes(40)))
url = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
TOKEN = ".".join([url(json.dumps({"alg": "HS256", "typ": "JWT"}).encode()), url(b'{"sub": "1"}'), url(RNG.randbytes(32))])
B64 = base64.b64encode(KEY).decode()
PEM = "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(re.findall(".{1,64}", B64)) + "\n-----END RSA PRIVATE KEY-----"


def brute_base(text):
    out = []
    names = ["password", "passwd", "secret", "token", "api_key", "apikey"]
    any_case = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n) for n in names)
    for m in re.finditer(rf"({any_case})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            out.append((m.start(), 1, m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 24:
            out.append((m.start(), 2, m.end()))
    return [(a, b, k) for a, k, b in sorted(out)]


@pytest.mark.parametrize("seed", range(30))
def test_base_spans(seed):
    rng = random.Random(seed)
    bits = ["Password", "api_key", "APIKEY", "toKen", "secret", "=", ":", " ", '"', "'", "abcdef", "x" * 5, "AKIA", "AKIA" + "Z9" * 8,
            "0123456789abcdef" * 2, "é", "ſecret", "toKen", "\n", "deadbeef", "token=token\"=\"abcdefgh"]
    text = "".join(rng.choice(bits) for _ in range(60))
    assert ss.base_spans(text) == brute_base(text)


@pytest.mark.parametrize(
    "text,kind",
    [(f"see {TOKEN} there", "jwt"), (f"é\n{PEM}\n", "pem"), (f"key {B64}.", "der"), (f"x {KEY.hex()} y", "der"), (base64.b64encode(SSH * 1).decode(), "ssh")],
)
def test_confirmed(text, kind):
    found = ss.confirmed_spans(text)
    assert [ss.KINDS[k] for *_, k in found] == [kind]
    a, b, _ = found[0]
    assert text[a:b].strip(".") in text and text[a : a + 3] in (TOKEN[:3], "---", B64[:3], KEY.hex()[:3], base64.b64encode(SSH).decode()[:3])


@pytest.mark.parametrize(
    "text",
    [
        "",
        "eyJub3QiOiAianNvbg.eyJub3QiOiAianNvbg.abcdefghijklmnopqrstuvwx",
        TOKEN.rsplit(".", 1)[0] + ".short",
        url(b'{"typ": "JWT"}') + "." + TOKEN.split(".", 1)[1],
        PEM.replace(B64[:8], "AAAAAAAA"),
        base64.b64encode(KEY + b"\0").decode(),
        base64.b64encode(KEY[:-1]).decode(),
        base64.b64encode(RNG.randbytes(300)).decode(),
        RNG.randbytes(100).hex(),
        base64.b64encode(SSH + b"xx").decode(),
        "a" * 200_000 + "." + "b" * 200_000,
        "e" + "y" * 300_000,
    ],
)
def test_not_confirmed(text):
    assert ss.confirmed_spans(text) == []


def test_nested_lengths():
    assert ss.der_items(der(0x30, der(0x30, der(2, b"\1")) + der(4, b"ab"))) == [(2, 1), (4, 2)]
    assert ss.der_items(b"\x30\x81\x03\x02\x01\x01") is None  # not the shortest length
    assert ss.der_items(b"\x30\x80\x00\x00") is None and ss.der_items(b"\x30") is None
    deep = b""
    for _ in range(40):
        deep = der(0x30, deep)
    assert ss.der_items(deep) == [] and not ss.der_key(deep)
    held = der(4, RNG.randbytes(40))
    for _ in range(5000):
        held = der(0x30, held)
    assert ss.der_items(held) == [(4, 40)] and ss.der_key(held)


def test_openssh_container():
    fields = b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b""))
    assert ss.ssh_key(ss.SSH_MAGIC + fields + b"\0\0\0\1") and not ss.ssh_key(ss.SSH_MAGIC + b"\0\0\0\xff")


def test_table(spark):
    rows = [(1, None), (None, f"token = {TOKEN}"), (2, ""), (3, f"{KEY.hex()}"), (3, f"{KEY.hex()}")]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, base string")
    out = ss.find_secrets(docs)
    got = {str(r["row"]["doc_id"]): (r["a"], r["b"]) for r in out.select("row", ss.joined(out["out.base"]).alias("a"), ss.joined(out["out.added"]).alias("b")).collect()}
    n = len(KEY.hex())
    assert got == {
        "1": ("", ""),
        "2": ("", ""),
        "None": (f"assign:0:{8 + len(TOKEN)}", f"jwt:8:{8 + len(TOKEN)}"),
        "3": (f"hex:0:{n}", f"der:0:{n}"),
    }
    assert ss.find_secrets(docs.limit(0)).collect() == []


HEADED = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC," + "0A" * 16 + "\n\n"
HEADED += "\n".join(re.findall(".{1,64}", base64.b64encode(RNG.randbytes(640)).decode())) + "\n-----END RSA PRIVATE KEY-----"


@pytest.mark.parametrize("ends", ["\n", "\r\n", "\\n", "\n    "])
@pytest.mark.parametrize("width", [64, 76])
def test_wrapped_keys(ends, width):
    body = ends.join(re.findall(f".{{1,{width}}}", B64))
    for text in (f"x {body} y", f"é\n{body}", body + "\n\nwords"):
        (span,) = ss.confirmed_spans(text)
        assert (text[span[0] : span[1]], ss.KINDS[span[2]]) == (body, "der")
    hexed = ends.join(re.findall(f".{{1,{width}}}", KEY.hex()))
    (span,) = ss.confirmed_spans(f"x {hexed} y")
    assert span == (2, 2 + len(hexed), ss.KINDS.index("der"))


def test_keys_as_they_are_written():
    kinds = lambda text: [ss.KINDS[k] for *_, k in ss.confirmed_spans(text)]
    escaped = '{"private_key": "' + PEM.replace("\n", "\\n") + '"}'
    assert kinds(escaped) == ["pem"] and kinds(HEADED) == ["pem"]
    assert kinds(HEADED.replace("\n", "\\n")) == ["pem"]
    assert kinds(HEADED.replace("DEK-Info", "Comment")) == []
    assert kinds("k " + url(KEY)) == ["der"] and kinds("ã" + TOKEN) == ["jwt"]
    assert kinds(f"{B64}\n{B64}\n{PEM}") == ["der", "der", "pem"]


@pytest.mark.parametrize("fill", [" ", "\n", "A", "0", "\\", "\\n", "-----BEGIN RSA PRIVATE KEY-----\n", "A: b\n", "eyJ.", "-", "A" * 64 + "\n", "ab "])
def test_long_fillers_cost_no_more_than_others(fill):
    n = 10_000_000
    text = "-----BEGIN RSA PRIVATE KEY-----" + fill * (n // len(fill))
    start = time.process_time()
    assert ss.confirmed_spans(text) == []
    assert time.process_time() - start < 8
