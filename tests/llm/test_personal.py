import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import personal

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def naive(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and personal.luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@+- ()9_%Zé\n0", max_size=60) | st.lists(st.sampled_from(["1.2.3.4", "256.1.1.1", "+1 (555) 123-45", "4111 1111 1111 1111", "4111-1111", "a@b.c", "@", ".", " ", "-", "x@y", "0"])).map("".join))
def test_plain_spans_are_those_of_the_patterns(text):
    assert sorted(personal.plain(text)) == sorted(naive(text))


DISGUISED = [
    ("write to jane.doe (at) example (dot) org now", ("email", "jane.doe (at) example (dot) org")),
    ("jane [AT] example.org", ("email", "jane [AT] example.org")),
    ("jane at example dot co dot uk", ("email", "jane at example dot co dot uk")),
    ("jаne@exаmple.cоm", ("email", "jаne@exаmple.cоm")),
    ("ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", ("email", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ")),
    ("host １９２.168.0.1 up", ("ip", "１９２.168.0.1")),
    ("host 10 dot 0 dot 0 dot 1", ("ip", "10 dot 0 dot 0 dot 1")),
    ("call plus four four two zero seven nine four six zero nine five eight", ("phone", "plus four four two zero seven nine four six zero nine five eight")),
    ("card four one one one one one one one one one one one one one one one.", ("card", "four one one one one one one one one one one one one one one one")),
    ("tel +٤٤ ٢٠ ٧٩٤٦ ٠٩٥٨", ("phone", "+٤٤ ٢٠ ٧٩٤٦ ٠٩٥٨")),
]


@pytest.mark.parametrize(("text", "want"), DISGUISED)
def test_disguises_map_back_to_the_source(text, want):
    found = personal.disguised(text, personal.plain(text))
    assert [(k, text[a:b]) for k, a, b in found] == [want]
    assert want[1] not in personal.redact(text)


WHOLE = [
    ("host 192 dot 168 dot one dot one up", ("ip", "192 dot 168 dot one dot one")),
    ("host 10 dot zero dot zero dot one up", ("ip", "10 dot zero dot zero dot one")),
    ("host one zero dot zero dot zero dot one up", ("ip", "one zero dot zero dot zero dot one")),
    ("host one dot one dot one dot 1 up", ("ip", "one dot one dot one dot 1")),
    ("host one dot one dot one dot one up", ("ip", "one dot one dot one dot one")),
    ("host 192.168.one.one up", ("ip", "192.168.one.one")),
    ("call plus 49 170 1234567 now", ("phone", "plus 49 170 1234567")),
    ("call plus 1 555 123 4567 now", ("phone", "plus 1 555 123 4567")),
    ("write bob at mail.example dot com now", ("email", "bob at mail.example dot com")),
]


@pytest.mark.parametrize(("text", "want"), WHOLE)
def test_disguises_beside_disguises(text, want):
    found = personal.disguised(text, personal.plain(text))
    assert [(k, text[a:b]) for k, a, b in found] == [want]
    assert want[1] not in personal.redact(text)


HALF_PLAIN = [
    ("аlice@example.com", "lice@example.com", ("email", "аlice@example.com")),
    ("user@example.cоm", "user@example.c", ("email", "user@example.cоm")),
    ("at 192.168.1.1０ now", "192.168.1.1", ("ip", "192.168.1.1０")),
    ("tel +1 555 123 456７ now", "+1 555 123 456", ("phone", "+1 555 123 456７")),
    ("bob@mail.example dot com!", "bob@mail.example", ("email", "bob@mail.example dot com")),
    ("b\u200bob@exam\u00adple.com", "ob@exam", ("email", "b\u200bob@exam\u00adple.com")),
]


@pytest.mark.parametrize(("text", "base", "want"), HALF_PLAIN)
def test_half_plain_identifiers_are_given_whole(text, base, want):
    known = personal.plain(text)
    assert all(base in text[a:b] or text[a:b] in base for _, a, b in known)
    found = personal.disguised(text, known)
    assert [(k, text[a:b]) for k, a, b in found] == [want]
    covered = personal.redact(text)
    at = text.index(want[1])
    assert set(covered[at : at + len(want[1])]) == {"*"} and covered[:at] + text[at : at + len(want[1])] + covered[at + len(want[1]) :] == text


MORE = [
    ("bob&#64;example.com", ("email", "bob&#64;example.com")),
    ("bob&#x40;example&period;com", ("email", "bob&#x40;example&period;com")),
    ("to bob @ example . com, please", ("email", "bob @ example . com")),
    ("to bob @ example.com please", ("email", "bob @ example.com")),
    ("bob-at-gmail-dot-com", ("email", "bob-at-gmail-dot-com")),
    ("bob\u2060@\ufeffexample.com", ("email", "bob\u2060@\ufeffexample.com")),
]


@pytest.mark.parametrize(("text", "want"), MORE)
def test_entities_spaces_dashes_and_characters_without_width(text, want):
    found = personal.disguised(text, personal.plain(text))
    assert [(k, text[a:b]) for k, a, b in found] == [want]


@pytest.mark.parametrize(
    "text",
    [
        "one hundred ninety two dot 168 dot 1 dot 1", "twenty one dot two dot three dot four", "one hundred dot 1 dot 1 dot 1",
        "write to a@b.com . Thanks", "we met @ home . Then we left", "R&D &amp; more", "a polka-dot-dress at-large", "price @ 5 . 3",
    ],
)
def test_number_words_and_signs_in_prose(text):
    assert personal.disguised(text, personal.plain(text)) == []


def test_endless_zeros_are_an_address_part():
    text = f"{'0' * 5000}1.2.3.{'0' * 5000}"
    assert ("ip", 0, len(text)) in personal.plain(text)


@pytest.mark.parametrize(
    "text",
    ["we met at home. dot the i", "look at example.org today", "the one two punch", "one at a time", "Привет, мир", "zwei at drei", "at dot com", "a dot b", "naïve café", "three four five"],
)
def test_clean_prose_is_left_alone(text):
    assert personal.disguised(text, personal.plain(text)) == []


def test_find(docs, long_text):
    rows = [(1, "é a@b.co 1.2.3.4 +44 20 7946 0958, 4111 1111 1111 1111 x (at) y (dot) z"), (2, None), (3, ""), (4, long_text), (5, "9" * 50_000 + "a" * 50_000), (1, "a@b.co"), (None, "+" * 5000)]
    found = sorted(personal.find(docs(rows)).collect(), key=lambda r: (r.doc_id or 0, r.spans))
    assert len(found) == len(rows)
    nothing = hashlib.sha256(b"").hexdigest()
    by_text = {(r.doc_id, r.spans): r for r in found}
    one = next(r for k, r in by_text.items() if k[0] == 1 and r.n_ip)
    base = "email:2:8,ip:9:16,phone:17:33,card:35:54"
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone) == (1, 1, 1, 1)
    assert one.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert one.spans == base + ",email:55:71" and one.n_disguised == 1
    assert all(r.base_sha256 == nothing and r.spans == "" for r in found if r.doc_id != 1)


def test_empty_table(docs):
    assert personal.find(docs([])).count() == 0
