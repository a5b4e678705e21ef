"""Surrogates against a plain Python version: what is found, what is exchanged for what, and what stays."""

import hashlib

import regex

from docgraph.llm import surrogates as S
from docgraph.llm.common import table

KEY = "k"
ASCII = {"d": "0-9", "w": "A-Za-z0-9_", "s": r" \t\n\x0b\f\r"}


def python(pattern: str) -> str:
    """Digits, word characters and white space are ASCII's, within brackets and without."""
    out, inside, k = "", False, 0
    while k < len(pattern):
        c = pattern[k]
        if c == "\\":
            of = ASCII.get(pattern[k + 1])
            out += (of if inside else f"[{of}]") if of else pattern[k : k + 2]
            k += 2
            continue
        inside = c == "[" or (inside and c != "]")
        out += c
        k += 1
    return out


PATTERNS = {k: regex.compile(python(p)) for k, p in S.PATTERNS.items()}
ANY = regex.compile("|".join(f"(?:{python(p)})" for p in S.PATTERNS.values()))


def luhn(digits: str) -> int:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 if d > 9 else d
    return total % 10


def mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def kind_of(entity: str, guarded: bool) -> str | None:
    kind = next((k for k, p in PATTERNS.items() if k != "secret" and regex.fullmatch(p, entity)), "secret")
    if kind == "card" and luhn("".join(c for c in entity if c.isdigit())):
        return "secret" if guarded else None
    return kind


def test_found_and_kept_as_by_hand(spark):
    """Over all documents: entities are found where a plain walk finds them, all between them stays, one for one."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    got = {r.doc_id: r for r in S.replace_entities(docs, KEY).collect()}
    given: dict[tuple[str, str], str] = {}
    seen = 0
    for r in docs.collect():
        text, new = r.text or "", got[r.doc_id].text or ""
        matches = list(ANY.finditer(text))
        guarded = {m[0] for m in PATTERNS["secret"].finditer(text)}
        kinds = [kind_of(m[0], m[0] in guarded) for m in matches]
        assert got[r.doc_id].n_entities == sum(k is not None for k in kinds)
        assert got[r.doc_id].kinds == sorted({k for k in kinds if k})
        if "person" in kinds:  # later mentions of a name are exchanged as well
            continue
        at, there = 0, 0
        for m, kind in zip(matches, kinds, strict=True):
            between = text[at : m.start()]
            assert new[there : there + len(between)] == between
            there += len(between)
            rest = text[m.end() : m.end() + 12]
            if kind is None:
                assert new[there : there + len(m[0])] == m[0]
                there += len(m[0])
            elif kind in ("email", "ip"):
                stop = new.index(rest, there) if rest else len(new)
                given.setdefault((kind, m[0].lower()), new[there:stop].lower())
                assert given[kind, m[0].lower()] == new[there:stop].lower()
                there = stop
            else:
                own = new[there : there + len(m[0])]
                assert own != m[0]
                assert [c.isalnum() for c in own] == [c.isalnum() for c in m[0]]
                assert given.setdefault((kind, m[0]), own) == own
                if kind == "card":
                    assert luhn("".join(c for c in own if c.isdigit())) == 0
                there += len(own)
                seen += 1
            at = m.end()
        assert new[there:] == text[at:]
    assert seen > 20
    assert len({(k, v) for (k, _), v in given.items()}) == len(given)


def plain_digits(kind: str, canon: str, attempt: int = 0) -> str:
    """The surrogate of a number or token, by the docstring: two hex digits of keyed SHA-256 for each character."""
    hexes = "".join(hashlib.sha256("|".join([KEY, str(n), kind, str(attempt), canon]).encode()).hexdigest() for n in range(4))
    pick = lambda i, n: int(hexes[i % 128 * 2 : i % 128 * 2 + 2], 16) % n
    out = ""
    for i, c in enumerate(canon, 1):
        if kind == "secret" and all(x in "0123456789abcdef" for x in canon):
            out += "0123456789abcdef"[pick(i, 16)]
        elif c.isdigit():
            out += str(pick(i, 8) + 2) if kind == "phone" and i == 1 else str(pick(i, 10))
        elif c.islower():
            out += "abcdefghijklmnopqrstuvwxyz"[pick(i, 26)]
        else:
            out += "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[pick(i, 26)] if c.isupper() else c
    return out


def replaced(spark, *rows: str) -> list:
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    return [(r.text, r.n_entities, r.kinds) for r in S.replace_entities(df, KEY).orderBy("doc_id").collect()]


def test_values_by_hand(spark):
    got = replaced(spark, "password = hunter2hunter2 end", "ssn 123-45-6789.", "call 555 123 4567 now", "token: 1234567890123abcdef0123 end")
    assert got[0][0] == f"password = {plain_digits('secret', 'hunter2hunter2')} end"
    ssn = plain_digits("ssn", "123456789")
    assert got[1][0] == f"ssn {ssn[:3]}-{ssn[3:5]}-{ssn[5:]}."
    phone = plain_digits("phone", "5551234567")
    assert got[2][0] == f"call {phone[:3]} {phone[3:6]} {phone[6:]} now"
    assert got[3][0] == f"token: {plain_digits('secret', '1234567890123abcdef0123')} end"


def test_secrets_of_digits_dont_stay(spark):
    """A value that looks like a card and fails the check sum is still a secret; the same digits elsewhere stay."""
    a, b, c, d = replaced(spark, "password = 1234567890123456 end", "token: 1234567890123abcdef0123 end", "order 1234567890123456 end", "secret=1.2.3.4abc9 and password: p@ss.word!123 end")
    assert a[1:] == b[1:] == (1, ["secret"])
    assert "1234567890123456" not in a[0]
    assert "1234567890123" not in b[0]
    assert "abcdef0123" not in b[0]
    assert c == ("order 1234567890123456 end", 0, [])
    assert not [x for x in ("1.2.3.4", "abc9", "p@ss", "word!123") if x in d[0]]


def test_a_number_with_and_without_its_country_is_one(spark):
    (text, n, kinds), = replaced(spark, "+1 (555) 123-4567 or (555) 123-4567 or +44 20 7946 0958.")
    one, two, three = text.removesuffix(".").split(" or ")
    assert (n, kinds) == (3, ["phone"])
    assert one == f"+1 {two}"
    assert two != "(555) 123-4567"
    assert three.startswith("+44 ")


def test_ibans_stay_valid(spark):
    (text, n, kinds), = replaced(spark, "pay DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432 soon")
    assert (n, kinds) == (2, ["iban"])
    for own in ("".join(text.split("pay ")[1].split(" or ")[0].split()), text.split(" or ")[1].split()[0]):
        assert mod97(own[4:] + own[:4]) == 1
        assert own[:2] in ("DE", "GB")
    assert "0532" not in text


def test_addresses_and_titles_go_whole(spark):
    (a, n, kinds), (b, m, _) = replaced(spark, "jörg.müller@example.com wrote", "Dr Anna Weber and Prof. Weber met Weber")
    assert (n, kinds, m) == (1, ["email"], 2)
    assert not [x for x in ("jö", "rg.", "müller", "ö", "ü") if x in a]
    assert a.endswith("@example.com wrote")
    assert not [x for x in ("Anna", "Weber") if x in b]
    assert b.split(" ")[2] == b.split(" ")[5] == b.split(" ")[7]


def test_columns_that_clash_with_its_own(spark):
    df = spark.createDataFrame([(1, "mail a@b.com", 7)], "doc_id long, text string, entity long")
    assert S.replace_entities(df, KEY).select("entity").first()[0] == 7
