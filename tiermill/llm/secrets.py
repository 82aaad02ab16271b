"""Secrets in texts: patterns, and encoded keys and signed tokens that are confirmed by their structure."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tiermill.llm.common import short_batches

# The patterns, with the least characters of the group that counts.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Whole runs: shorter ones are not tried at all.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}+")
PATTERNS = (("assign", ASSIGN, 2, 8), ("access", ACCESS, 0, 16), ("hex", HEX, 0, 32))
# In the order in which spans that start together are listed; the last three are confirmed ones.
KINDS = ("assign", "access", "hex", "pem", "key", "jwt")

# Runs that may hold an encoded key, also wrapped into lines (by line ends or written-out ones). The
# shortest private key, of 39 bytes, has 52 characters in base64 and 78 in hexadecimal digits.
BREAK = r"(?:\r?\n|\\r\\n|\\n)"
BASE64_RUN = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{40,}}+(?:{BREAK}(?!-----)[A-Za-z0-9+/_-]++)*+=*+")
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{72,}+")
# How the encodings of a DER sequence, of an OpenSSH key and of an armored block begin.
BASE64_START = re.compile(r"M[C-I]|b3BlbnNzaC1rZXktdjE|LS0tLS1CRUdJTi")
HEX_START = re.compile(r"30|6f70656e7373682d6b65792d7631|2d2d2d2d2d424547494e", re.IGNORECASE)
MARKER = re.compile(r"-----(BEGIN|END) ((?:[A-Z0-9]+ )*PRIVATE KEY)-----")
STANDARD, SAFE = re.compile("[A-Za-z0-9+/]*"), re.compile("[A-Za-z0-9_-]*")
# Three parts with dots between; the first begins like an object's opening brace and a quote or space.
TOKEN = re.compile(
    r"(?<![A-Za-z0-9_-])(e[yw][A-Za-z0-9_-]{8,}+)\.([A-Za-z0-9_-]{2,}+)\.([A-Za-z0-9_-]++)(?!\.[A-Za-z0-9_-])"
)

# DER tags, the identifiers of password-based encryption, the magic of OpenSSH keys.
INTEGER, BITS, OCTETS, OBJECT, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30
ENCRYPTION = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
OPENSSH = b"openssh-key-v1\0"
MOST_PARTS = 9
# Bytes of a signature by its algorithm; those of RSA are at least as long as 1,024 bits.
SIGNATURE_BYTES = {
    "HS256": (32,), "HS384": (48,), "HS512": (64,), "ES256": (64,), "ES256K": (64,), "ES384": (96,),
    "ES512": (132,), "EdDSA": (64, 114),
}
RSA_ALGORITHMS = ("RS256", "RS384", "RS512", "PS256", "PS384", "PS512")
RSA_SIGNATURE_BYTES = 128


def element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and stop of the content of the DER element at ``at``, if it ends within ``end``: with
    a definite length in the fewest bytes."""
    if at + 2 > end:
        return None
    size, start = data[at + 1], at + 2
    if size >= 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4 or start + width > end:
            return None
        size, start = int.from_bytes(data[start : start + width], "big"), start + width
        if size < (0x80 if width == 1 else 1 << 8 * (width - 1)):
            return None
    return (data[at], start, start + size) if start + size <= end else None


def elements(data: bytes, start: int, stop: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``data[start:stop]`` exactly, or None if they do not, or are more than any
    key has."""
    found = []
    while start < stop:
        one = element(data, start, stop)
        if one is None or len(found) == MOST_PARTS:
            return None
        found.append(one)
        start = one[2]
    return found


def _algorithm(data: bytes, start: int, stop: int) -> bytes | None:
    """The identifier that an algorithm's sequence begins with."""
    inner = elements(data, start, stop)
    if not inner or inner[0][0] != OBJECT or inner[0][1] == inner[0][2]:
        return None
    return data[inner[0][1] : inner[0][2]]


def der_key(data: bytes, at: int = 0) -> int | None:
    """Where the private key that begins at ``at`` ends: RSA, DSA, elliptic curve, PKCS 8, or PKCS 8
    under a password. None if there is no such key."""
    outer = element(data, at, len(data))
    if outer is None or outer[0] != SEQUENCE:
        return None
    # What every form begins with is looked at before the parts are taken apart.
    if data[outer[1] : outer[1] + 2] != b"\x02\x01" and data[outer[1] : outer[1] + 1] != b"\x30":
        return None
    parts = elements(data, outer[1], outer[2])
    if not parts or len(parts) < 2:
        return None
    tags = [tag for tag, _, _ in parts]
    first = data[parts[0][1] : parts[0][2]]
    if tags[0] == SEQUENCE:
        named = _algorithm(data, *parts[0][1:])
        encrypted = tags == [SEQUENCE, OCTETS] and named and named.startswith(ENCRYPTION)
        return outer[2] if encrypted else None
    if tags[0] != INTEGER or first not in (b"\0", b"\1"):
        return None
    if all(tag == INTEGER for tag in tags):
        # Version, then 8 numbers (RSA) or 5 (DSA), none of them empty.
        filled = all(stop > start for _, start, stop in parts)
        return outer[2] if filled and len(tags) in (6, 9) else None
    if tags[1:3] == [SEQUENCE, OCTETS] and all(tag in (0xA0, 0x81, 0xA1) for tag in tags[3:]):
        return outer[2] if _algorithm(data, *parts[1][1:]) else None
    if tags[1] == OCTETS and first == b"\1" and all(tag in (0xA0, 0xA1) for tag in tags[2:]):
        whole = all(elements(data, start, stop) for _, start, stop in parts[2:])
        long_enough = parts[1][2] - parts[1][1] >= 20
        return outer[2] if whole and long_enough else None
    return None


def openssh_key(data: bytes, at: int = 0) -> int | None:
    """Where the OpenSSH private key that begins at ``at`` ends, by its nested lengths, or None."""
    if not data.startswith(OPENSSH, at):
        return None
    at += len(OPENSSH)

    def text() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        start, at = at + 4, at + 4 + size
        return data[start:at] if at <= len(data) else None

    if text() is None or text() is None or text() is None or at + 4 > len(data):
        return None
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    for _ in range(keys):
        if at + 4 > len(data) or not text():
            return None
    return at if keys and at + 4 <= len(data) and text() else None


def _bytes(text: str) -> bytes:
    """Bytes of as much of a run of base64 digits, in either alphabet, as makes whole ones."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    text = text[:-1] if len(text) % 4 == 1 else text
    return base64.b64decode(text + "=" * (-len(text) % 4))


def _mixed(digits: str) -> bool:
    return not (STANDARD.fullmatch(digits) or SAFE.fullmatch(digits))


def _decoded(text: str) -> bytes | None:
    """Bytes of base64 in one of the alphabets, with or without padding."""
    digits = text.rstrip("=")
    return None if len(digits) % 4 == 1 or _mixed(digits) else _bytes(digits)


def _armored_key(label: str, body: str) -> bool:
    """True if what stands between the markers is a key of the kind that they name."""
    body = re.sub(r"\\r|\\n|\r", "\n", body.replace("\\r\\n", "\n"))
    head, blank, rest = body.partition("\n\n")
    headers = re.findall(r"^([A-Za-z-]+):[ \t]*(.*)$", head, re.MULTILINE) if blank else []
    data = _decoded(re.sub(r"\s+", "", rest if headers else body))
    if not data:
        return False
    named = dict(headers)
    if "ENCRYPTED" in named.get("Proc-Type", ""):
        # The key is encrypted as a whole: its cipher, start value and blocks are what can be seen.
        start = re.fullmatch(r"[A-Z0-9-]+,([0-9A-Fa-f]+)\s*", named.get("DEK-Info", ""))
        return bool(start) and len(start[1]) in (16, 32) and len(data) % (len(start[1]) // 2) == 0
    whole = openssh_key(data) if label.startswith("OPENSSH") else der_key(data)
    return whole == len(data)


def armored(text: str) -> list[tuple[int, int]]:
    """Spans of armored private keys: a BEGIN marker, the next marker being its END, and a key in
    between."""
    if "-----BEGIN" not in text:
        return []
    found, opened = [], None
    for marker in MARKER.finditer(text):
        if marker[1] == "BEGIN":
            opened = marker
        elif opened is not None:
            if opened[2] == marker[2] and _armored_key(marker[2], text[opened.end() : marker.start()]):
                found.append((opened.start(), marker.end()))
            opened = None
    return found


def _keys_in(run: str, starts: re.Pattern, digits: int, size: int, decode) -> list[tuple[int, int]]:
    """Spans of the keys in a run of digits, of which ``digits`` make ``size`` bytes. The run is decoded
    once for each way in which a key can lie in it."""
    found, at, decoded = [], 0, {}
    while start := starts.search(run, at):
        begin, at = start.start(), start.start() + 1
        shift = begin % digits
        if shift not in decoded:
            data = decode(run[shift:])
            decoded[shift] = data, dict(armored(data.decode("latin-1")))
        data, blocks = decoded[shift]
        place = begin // digits * size
        end = blocks.get(place) or openssh_key(data, place) or der_key(data, place)
        if end:
            at = shift + -(-end * digits // size)
            found.append((begin, at))
    return found


def encoded(text: str) -> list[tuple[int, int]]:
    """Spans of private keys written in base64 or hexadecimal digits, without armor, wherever in a run
    of digits they begin; they end where their lengths say, with the padding."""
    found = []
    for run in BASE64_RUN.finditer(text):
        if not BASE64_START.search(run[0]):
            continue
        breaks = list(re.finditer(BREAK, run[0]))
        padded = re.sub(BREAK, "", run[0]) if breaks else run[0]
        digits = padded.rstrip("=")
        for begin, end in _keys_in(digits, BASE64_START, 4, 3, _bytes):
            if _mixed(digits[begin:end]):
                continue
            # The padding belongs to a key that ends with the run.
            end = len(padded) if end == len(digits) else end
            for gap in breaks:  # back to places in the text
                begin += len(gap[0]) if gap.start() <= begin else 0
                end += len(gap[0]) if gap.start() < end else 0
            found.append((run.start() + begin, run.start() + end))
    for run in HEX_RUN.finditer(text):
        whole = _keys_in(run[0], HEX_START, 2, 1, lambda part: bytes.fromhex(part[: len(part) // 2 * 2]))
        found += [(run.start() + begin, run.start() + end) for begin, end in whole]
    return found


def signed(header: str, payload: str, signature: str) -> bool:
    """True for a token whose header names a signature, which has the length of one."""
    parts = [_decoded(part) for part in (header, payload, signature)]
    if not all(parts):
        return False
    try:
        named = json.loads(parts[0])
    except (ValueError, RecursionError):
        return False
    algorithm = named.get("alg") if isinstance(named, dict) else None
    if not isinstance(algorithm, str):
        return False
    if algorithm in RSA_ALGORITHMS:
        return len(parts[2]) >= RSA_SIGNATURE_BYTES
    return len(parts[2]) in SIGNATURE_BYTES.get(algorithm, ())


def patterns(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the plain patterns: leftmost matches that do not overlap, of which those
    that are too short are dropped."""
    found, low = [], text.lower()
    for kind, (_, pattern, group, least) in enumerate(PATTERNS):
        # Most texts hold none of the words, which is quicker to see than that nothing matches.
        if pattern is ASSIGN and not any(word in low for word in KEYWORDS):
            continue
        for match in pattern.finditer(text):
            if match.end(group) - match.start(group) >= least:
                found.append((match.start(), kind, match.end()))
    return found


def confirmed(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what its structure confirms. A key inside an armored one is not listed
    again."""
    blocks = armored(text)
    found = [(start, KINDS.index("pem"), end) for start, end in blocks]
    for start, end in encoded(text):
        if not any(a <= start < b for a, b in blocks):
            found.append((start, KINDS.index("key"), end))
    for token in TOKEN.finditer(text):
        if signed(*token.groups()):
            found.append((token.start(), KINDS.index("jwt"), token.end()))
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans)])


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of the pattern spans by kind, those of the confirmed ones, ``base`` (the
    pattern spans), its ``base_sha256`` and ``spans`` (all spans) of every row's whole text.

    Spans are written ``kind:start:end`` in code points, the end being the first place after it, sorted
    by start and then by kind, and joined by commas. Confirmed are: armored private keys (``pem``),
    private keys in base64 or hexadecimal digits, also an armored one that is encoded again (``key``),
    and signed tokens (``jwt``). Public keys, certificates and unsigned tokens are none. Null and empty
    texts hold nothing, null ids and repeated rows are kept, other columns are ignored; an empty table
    gives an empty result.
    """
    short_batches(docs.sparkSession)
    names = [f"n_{kind}" for kind in KINDS]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, base, every = [[] for _ in KINDS], [], []
            for text in batch["text"].to_pylist():
                plain = patterns(text) if text else []
                added = confirmed(text) if text else []
                kinds = [kind for _, kind, _ in plain + added]
                for kind, held in enumerate(counts):
                    held.append(kinds.count(kind))
                base.append(_joined(plain))
                every.append(_joined(plain + added))
            digests = [hashlib.sha256(b.encode()).hexdigest() for b in base]
            columns = [batch["doc_id"], *[pa.array(c, pa.int64()) for c in counts]]
            columns += [pa.array(c, pa.string()) for c in (base, digests, every)]
            yield pa.RecordBatch.from_arrays(
                columns, names=["doc_id", *names, "base", "base_sha256", "spans"]
            )

    counted = ", ".join(f"{name} long" for name in names)
    return docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text").mapInArrow(
        scan, f"doc_id long, {counted}, base string, base_sha256 string, spans string"
    )
