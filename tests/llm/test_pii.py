import hashlib
import random
import re

from plinth.llm.pii import anchors, find_pii, luhn, spans

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def base(text):
    return sorted((s for s in spans(text, anchors()) if s[0] in ("email", "ip", "card", "phone")), key=lambda s: (("email", "ip", "card", "phone").index(s[0]), s[1]))


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_base_spans_equal_the_patterns_on_random_texts():
    random.seed(3)
    alphabets = ["a@.-1", "0123456789 -", "+1 ().-5", "12.", "é@a.b1+ -", "1.@+-a \n"]
    automaton = anchors()
    for i in range(6000):
        text = "".join(random.choices(alphabets[i % len(alphabets)], k=random.randrange(60)))
        got = [s for s in spans(text, automaton) if s[0] in ("email", "ip", "card", "phone")]
        assert sorted(got) == sorted(brute(text)), text


def test_cases():
    text = "Mail é.joe@x-1.example.org, 4111 1111-1111 1111 or +1 (017) 555-7713 at 10.0.0.255 and 10.0.0.256; token = \"04dbebab91ab85\" see https://a.example/x?y=1. IBAN DE89 3704 0044 0532 0130 00"
    found = {k: text[a:b] for k, a, b in spans(text, anchors())}
    assert found["email"] == ".joe@x-1.example.org" and found["card"].startswith("4111") and found["ip"] == "10.0.0.255"
    assert found["secret"] == "04dbebab91ab85" and found["url"] == "https://a.example/x?y=1" and found["account"] == "DE89 3704 0044 0532 0130 00"
    assert base(text) == brute(text)


def test_query_rows(spark):
    long = "a" * 200_000 + "@x.yz " + "1" * 100_000
    rows = [(1, "a@b.cd 1.2.3.4", 9), (1, "a@b.cd 1.2.3.4", 9), (2, None, None), (None, "", 1), (3, long, 2)]
    got = find_pii(spark.createDataFrame(rows, "doc_id long, text string, n_email int")).collect()
    assert sorted(map(str, got)) == sorted(
        str(type(got[0])(doc_id=i, n_email=len([s for s in found if s[0] == "email"]), n_ip=len([s for s in found if s[0] == "ip"]), n_card=0, n_phone=0, base_sha256=hashlib.sha256(names.encode()).hexdigest(), spans=names))
        for i, t, _ in rows
        for found in [brute(t or "")]
        for names in [",".join(f"{k}:{a}:{b}" for k, a, b in found)]
    )
    assert find_pii(spark.createDataFrame([], "doc_id long, text string")).count() == 0
