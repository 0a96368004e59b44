"""Personal data and secrets against plain Python."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from wayfare.llm import pii, secrets

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


def joined(spans, kinds=pii.KINDS):
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)


def noise(seed, n=160):
    rng = random.Random(seed)
    parts = ["a", "@", ".", "-", "+", "1", "12", "255.1.1.1", "300.1.2.3", " ", "é", "😀", "\n", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713", "x@y.z", "_", "%", "a@b.c-d", "0007.1.2.3", "(", ")", "9807915762804490"]
    return "".join(rng.choice(parts) for _ in range(n))


EDGE = [
    None, "", " ", "x@y.z", "a@b.c%d@e.f.g", "a@b", "1.2.3.4.5.6.7.8", "256.1.1.1", "00255.1.1.1", "12  3456789012345", "4111111111111111" * 3,
    "+1 (017) 555-7713.", "+12345678", "+1234567890123456", "a" * 40000 + "@b.c", "1" * 30000, "1 " * 20000, "a@b.c " * 3000, "a@" + "b." * 20000 + "c", "é 😀 x@y.z 😀",
]


@pytest.fixture(scope="module")
def rows():
    return [*enumerate(EDGE), (100, noise(1)), (100, noise(1)), (None, noise(2)), *((200 + i, noise(i)) for i in range(60))]


def test_personal_data_equals_plain_python(frame, rows):
    got = sorted((r["doc_id"], r["base_sha256"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in pii.personal_data(frame(rows)).fillna({"doc_id": -1}).collect())
    want = []
    for i, t in rows:
        spans = base_spans(t)
        want.append((-1 if i is None else i, hashlib.sha256(joined(spans).encode()).hexdigest(), *[sum(k == n for _, k, _ in spans) for n in range(4)]))
    assert got == sorted(want)


def test_personal_data_of_documents(documents, texts):
    for r in pii.personal_data(documents).collect():
        spans = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(joined(spans).encode()).hexdigest()
        assert set(joined(spans).split(",")) <= set(r["spans"].split(","))


def test_contexts_discover_unseen_identifiers(frame):
    seeds = [(i, f"words here contact-mail: user{i}@site{i}.org and more the 77 the end") for i in range(12)]
    rows = [*seeds, (50, "contact-mail: bob@localhost today"), (51, "the 99 of the the the"), (52, "nothing here")]
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(frame(rows)).collect()}
    assert got[50] == "email:14:27"
    assert got[51] == got[52] == ""


def test_glued_signs_are_no_context(frame):
    rows = [(i, f"write to (user{i}@site{i}.org) or mailto:me{i}@site{i}.org now") for i in range(12)]
    rows += [(50, "see ( 42 things )"), (51, "mailto: 43"), (52, "\nword x@y.z,tail 7\ttail\n44")]
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(frame(rows)).collect()}
    assert got[50] == got[51] == "" and got[52] == "email:6:11"
    found = pii.matches(frame(rows), "doc_id", "text").filter("kind = 0 and value is not null").select("doc_id", "left").distinct().collect()
    assert {r["left"] for r in found if r["doc_id"] < 50} == {""} and [r["left"] for r in found if r["doc_id"] == 52] == ["word"]


def test_found_instances_bring_new_patterns(frame):
    rows = [(i, f"phone: +1 555 000 10{i:02d} and more words") for i in range(40)]
    rows += [(100 + i, f"phone: 555-77{i:02d} here") for i in range(20)] + [(200 + i, f"tel: 555-77{i:02d} there") for i in range(20)]
    rows += [(300, "tel: 555-9999 new"), (301, "ring: 555-8888 now"), (302, "the 99 of the the the"), (303, "tel: (555) 123-4567, then")]
    rows += [(400 + i, f"tel: 555-66{i:02d} x") for i in range(6)] + [(500 + i, f"ring: 555-66{i:02d} x") for i in range(6)]
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(frame(rows)).collect()}
    assert got[100] == "phone:7:15" and got[200] == "phone:5:13" and got[300] == "phone:5:13"
    assert got[301] == "phone:6:14" and got[302] == "" and got[303] == "phone:5:20"


def test_redaction_keeps_columns_and_replaces_spans(frame):
    rows = [(1, "mail x@y.zz now 10.0.0.1!"), (2, "clean"), (3, None), (1, "mail x@y.zz now 10.0.0.1!"), (None, "a@b.c"), (4, "+1 (017) 555-7713 é a@b.c")]
    df = frame(rows)
    out = pii.redacted(df)
    assert out.columns == df.columns
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect())
    assert got == [(0, "[EMAIL]"), (1, "mail [EMAIL] now [IP]!"), (1, "mail [EMAIL] now [IP]!"), (2, "clean"), (3, ""), (4, "[PHONE] é [EMAIL]")]


def test_redaction_leaves_nothing_of_overlapping_spans(frame):
    rows = [(1, "call +1 555 123 4567@10.0.0.1 now"), (2, "x 10.0.0.4 111 1111 1111 1111 y"), (3, "a@b.c d@e.f")]
    assert [k for _, k, _ in base_spans(rows[1][1])] == [1, 2]
    got = {r["doc_id"]: r["text"] for r in pii.redacted(frame(rows)).collect()}
    assert got == {1: "call [PHONE] now", 2: "x [IP] y", 3: "[EMAIL] [EMAIL]"}


def test_personal_data_runs_no_python(documents):
    plan = pii.matches(documents, "doc_id", "text")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secret_base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secrets_equal_plain_python(frame, documents, texts):
    extra = ["ToKen: abcdef", "apikey='12345' api_KEY = \"abc/def+g\"", "AKIA" + "A" * 16, "AKIA123", "f" * 24 + "F" + "0" * 23, "toſen = abcdefgh", "password" + " " * 50000 + "=x", None, "", "secret=" + "a" * 90000]
    rows = [*enumerate(extra), (3, extra[3]), (None, extra[0])]
    for df, known in ((frame(rows), rows), (documents, list(texts.items()))):
        got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["base_sha256"]) for r in secrets.secret_spans(df).collect())
        want = sorted((-1 if i is None else i, hashlib.sha256(joined(secret_base(t), secrets.KINDS).encode()).hexdigest()) for i, t in known)
        assert got == want


def test_guess_cost_ranks_values():
    weak, strong = ["password", "aaaaaaaaaaaa", "qwertyuiop", "20230115", "dragon2021", "P@ssword"], ["xK9#qLz7Wv!p", "b7Qe-91xTz_kW0", "pVz8Lq2mXr"]
    assert max(map(secrets.guess_bits, weak)) < secrets.MIN_BITS < min(map(secrets.guess_bits, strong))
    assert secrets.guess_bits("") == 0


def test_context_values_are_added_by_cost():
    spans, _ = secrets.find_secrets("pwd: xK9#qLz7Wv!pQ and pass: dragon2021, the pass of summer")
    assert spans == [(5, 3, 18)]


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("password: xK9#qLz7Wv!pQ", "xK9#qLz7Wv!pQ"),
        ('secret = "G7$kd9!xQ2@z"', "G7$kd9!xQ2@z"),
        ("passwd=Tr@9!xQ#zv8&Lm", "Tr@9!xQ#zv8&Lm"),
        ("db_api_key='k9!xQ7#vTz20'", "k9!xQ7#vTz20"),
        ("my password is xK9qLz7WvpQ", "xK9qLz7WvpQ"),
        ("Authorization: Bearer q7XbD2fV9kTz", "q7XbD2fV9kTz"),
        ("token: Bearer q7XbD2fV9kTz", "q7XbD2fV9kTz"),
        ("password=abcdef#9!xQzT7$kk", "abcdef#9!xQzT7$kk"),
    ],
)
def test_whole_values_of_credential_contexts(text, value):
    spans, bits = secrets.find_secrets(text)
    assert [text[s:e] for s, k, e in spans if k == 3] == [value] and bits >= secrets.MIN_BITS


def test_prose_and_covered_values_add_nothing():
    for text in ("the password is incorrect.", "The token is case-sensitive", "bearer certificates were sold", "password is REQUIRED", "token=abcdef1234567890xyz, then", "secret is dragon2021"):
        assert not [s for s in secrets.find_secrets(text)[0] if s[1] == 3]


def test_empty_tables(frame):
    empty = frame([(1, "a")]).filter("doc_id > 5")
    assert pii.personal_data(empty).count() == secrets.secret_spans(empty).count() == pii.redacted(empty).count() == 0
