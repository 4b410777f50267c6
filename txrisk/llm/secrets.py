"""Credentials, addresses of machines and wallets, and identity numbers: further
kinds of personal data (operator 4).

Each finder gives proposed spans with what its validator adds to their score.
Every pattern is linear in the text.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import ipaddress
import json
import math
import re
import string
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

Proposal = tuple[int, int, float]

# A validator that few innocent strings pass; one that a random string passes in
# one case of about twenty, and which therefore needs a context word as well.
STRONG, WEAK = 0.5, 0.25

KEY_BLOCK = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ ){0,4}PRIVATE KEY(?: BLOCK)?)-----")
TOKEN = re.compile(
    r"(?<![A-Za-z0-9_-])(?:"
    r"(?P<aws>A[KS]IA[A-Z2-7]{16})"
    r"|(?P<checked>gh[opsur]_[A-Za-z0-9]{36})"
    r"|(?P<fixed>glpat-[A-Za-z0-9_-]{20}|AIza[A-Za-z0-9_-]{35}|[rs]k_live_[A-Za-z0-9]{24,}"
    r"|xox[abeprs]-[A-Za-z0-9]+(?:-[A-Za-z0-9]+)+|npm_[A-Za-z0-9]{36})"
    r"|(?P<web>eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)"
    r")(?![A-Za-z0-9_-])"
)
NAMED = re.compile(
    r"(?:api[_-]?key|access[_-]?key|auth[_-]?key|private[_-]?key|secret(?:[_-]?key)?|token"
    r"|passw(?:or)?d|passwd|pwd|credentials?)[\"']?[\x20\t]*(?:=>|:=|[:=])[\x20\t]*[\"']?"
    r"(?P<value>[^\s\"',;<>]+)",
    re.I,
)
IPV6 = re.compile(r"(?<![A-Za-z0-9:.])[0-9A-Fa-f]{0,4}:[0-9A-Fa-f:]*:[0-9A-Fa-f.]*(?![A-Za-z0-9:])")
WALLET = re.compile(r"(?<![A-Za-z0-9])(?:[13][1-9A-HJ-NP-Za-km-z]{25,34}|bc1[02-9ac-hj-np-z]{11,71})(?![A-Za-z0-9])")
IDENTITY = re.compile(
    r"(?<![A-Za-z0-9.+-])(?:"
    r"(?P<letter>[0-9XYZ][0-9]{7}-?[A-Z])"
    r"|(?P<ten>[0-9]{3}[\x20-]?[0-9]{3}[\x20-]?[0-9]{4})"
    r"|(?P<nine>[0-9]{9})"
    r"|(?P<fifteen>[12]\x20?[0-9]{2}\x20?[0-9]{2}\x20?[0-9]{2}\x20?[0-9]{3}\x20?[0-9]{3}\x20?[0-9]{2})"
    r")(?![A-Za-z0-9-])"
)

# Fixed values of public formats: check letters by remainder of 23, the alphabets
# of wallet addresses and of token checksums.
CHECK_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase


def key_blocks(text: str) -> Iterator[Proposal]:
    """A private key from its header to its footer; the header alone if another
    header or the end of the text comes first."""
    headers = list(KEY_BLOCK.finditer(text))
    for m, following in zip(headers, [*headers[1:], None]):
        footer = f"-----END {m[1]}-----"
        end = text.find(footer, m.end(), following.start() if following else len(text))
        yield m.start(), end + len(footer) if end >= 0 else m.end(), STRONG


def token_checksum(token: str) -> bool:
    """Whether the last six characters are the CRC-32 of those after the prefix."""
    body, check = token[4:-6], token[-6:]
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0") == check


def web_token(token: str) -> bool:
    """Whether the first of three parts is a header that names its algorithm."""
    head = token.split(".", 1)[0]
    try:
        header = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (binascii.Error, ValueError, RecursionError):
        return False
    return isinstance(header, dict) and "alg" in header


def tokens(text: str) -> Iterator[Proposal]:
    """Tokens with an issuer's prefix."""
    for m in TOKEN.finditer(text):
        kind = m.lastgroup
        if kind == "checked":
            bonus = STRONG if token_checksum(m[0]) else 0.0
        elif kind == "web":
            bonus = STRONG if web_token(m[0]) else 0.0
        else:
            bonus = STRONG if looks_random(m[0]) else 0.0
        yield m.start(), m.end(), bonus


def looks_random(value: str) -> bool:
    """Letters and digits, with little repetition: a word or a date is neither."""
    if len(value) < 12 or value.isalpha() or not any(c.isalpha() for c in value):
        return False
    if not any(c.isdigit() for c in value):
        return False
    size = len(value)
    entropy = -sum(n / size * math.log2(n / size) for n in Counter(value).values())
    return entropy >= 2.8


def named_values(text: str) -> Iterator[Proposal]:
    """Values assigned to a name such as ``api_key``; the span is the value's."""
    for m in NAMED.finditer(text):
        if looks_random(m["value"]):
            yield *m.span("value"), STRONG


def ipv6(text: str) -> Iterator[Proposal]:
    for m in IPV6.finditer(text):
        found = m[0].rstrip(".")
        try:
            address = ipaddress.IPv6Address(found)
        except ValueError:
            continue
        groups = sum(map(bool, found.split(":")))
        if address.is_unspecified or not any(c.isdigit() for c in found):
            continue
        # two short groups are as likely names of a program's parts
        yield m.start(), m.start() + len(found), STRONG if groups >= 3 else WEAK


def base58check(address: str) -> bool:
    number = 0
    for c in address:
        number = number * 58 + BASE58.index(c)
    if number >> 200:
        return False
    raw = number.to_bytes(25, "big")
    return hashlib.sha256(hashlib.sha256(raw[:21]).digest()).digest()[:4] == raw[21:]


def bech32(address: str) -> bool:
    values = [3, 3, 0, 2, 3, *map(BECH32.index, address[3:])]  # "bc" expanded
    check = 1
    for value in values:
        top = check >> 25
        check = (check & 0x1FFFFFF) << 5 ^ value
        for bit, step in enumerate(BECH32_STEPS):
            if top >> bit & 1:
                check ^= step
    return check in (1, 0x2BC830A3)


def wallets(text: str) -> Iterator[Proposal]:
    for m in WALLET.finditer(text):
        if (bech32 if m[0].startswith("bc1") else base58check)(m[0]):
            yield m.start(), m.end(), STRONG


def check_letter(number: str) -> bool:
    first = {"X": "0", "Y": "1", "Z": "2"}.get(number[0], number[0])
    return CHECK_LETTERS[int(first + number[1:8]) % 23] == number[-1]


def eleven_of_ten(number: str) -> bool:
    """Weights 10 to 2 and a last digit that makes the sum a multiple of 11."""
    total = sum(int(d) * w for d, w in zip(number, range(10, 1, -1)))
    return (11 - total % 11) % 11 == int(number[9])


def eleven_of_nine(number: str) -> bool:
    total = sum(int(d) * w for d, w in zip(number, (9, 8, 7, 6, 5, 4, 3, 2, -1)))
    return total % 11 == 0 and number != "0" * 9


def key_of_97(number: str) -> bool:
    return 97 - int(number[:13]) % 97 == int(number[13:])


def identity_numbers(text: str) -> Iterator[Proposal]:
    for m in IDENTITY.finditer(text):
        compact = m[0].replace(" ", "").replace("-", "")
        kind = m.lastgroup
        if kind == "letter" and check_letter(compact):
            yield m.start(), m.end(), WEAK
        elif kind == "ten" and eleven_of_ten(compact):
            yield m.start(), m.end(), WEAK
        elif kind == "nine" and eleven_of_nine(compact):
            yield m.start(), m.end(), WEAK
        elif kind == "fifteen" and key_of_97(compact):
            yield m.start(), m.end(), WEAK


# In order of preference where spans overlap.
FINDERS: dict[str, Callable[[str], Iterator[Proposal]]] = {
    "private_key": key_blocks,
    "token": tokens,
    "credential": named_values,
    "ipv6": ipv6,
    "wallet": wallets,
    "identity": identity_numbers,
}
PATTERN_SCORE = {
    "private_key": 0.4, "token": 0.3, "credential": 0.4, "ipv6": 0.3, "wallet": 0.3, "identity": 0.15,
}
CONTEXT = {
    "private_key": set(),
    "token": {"token", "key", "secret", "bearer", "authorization", "credentials"},
    "credential": set(),
    "ipv6": {"ip", "ipv", "address", "host", "server", "client", "adresse", "dirección"},
    "wallet": {"wallet", "bitcoin", "btc", "address"},
    "identity": {
        "dni", "nie", "nif", "nhs", "bsn", "insee", "nir", "identity", "identidad", "patient",
        "burgerservicenummer", "sécurité", "sociale", "passport", "taxpayer",
    },
}
