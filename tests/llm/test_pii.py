import hashlib
import random
import re

import pytest

from strandsieve.llm import pii

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for k, (kind, expression) in enumerate(BASE.items()):
        for m in re.finditer(expression, text):
            digits = re.sub(r"\D", "", m[0])
            holds = {
                "email": lambda: True, "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")), "card": lambda d=digits: 14 <= len(d) <= 19 and pii.luhn(d), "phone": lambda d=digits: 10 <= len(d) <= 15,
            }[kind]()
            if holds:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_luhn():
    assert pii.luhn("4111111111111111")
    assert not pii.luhn("4111111111111112")


def test_base_spans_are_those_of_the_plain_expressions():
    rng = random.Random(1)
    fixed = ["a@b.c@d.e", "x@y.z.w", "@a.b", "a@@b.c", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1", "+1 (826) 555-4081", "4111 1111 1111 1111", "4111-1111-1111-1111 12", "+1+1+1 234 567 8901", "é@x.y a%b+c@x-y.zz", "+12345678901234567", "a" * 999 + "@b.co", ""]
    for text in fixed + ["".join(rng.choice("a.@1 4-+()%\n") for _ in range(rng.randint(0, 40))) for _ in range(3000)]:
        assert pii.base_spans(text) == plain(text), text


def test_linear_on_long_runs():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000, "a@" * 100_000, "+" * 200_000, "+1" + " (" * 100_000, "1 " * 100_000):
        spans = pii.base_spans(text)
        pii.candidates(text, spans)


def found(make, *rows):
    return {r.doc_id: r for r in pii.find_personal_data(make(*rows)).collect()}


def test_contract_columns(make):
    text = "mail a@b.co and 10.0.0.1 or +1 (826) 555-4081 or 4111 1111 1111 1111"
    r = found(make, (1, text), (2, None))[1]
    want = pii.shown(plain(text))
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    assert (r.spans, r.base_sha256) == (want, hashlib.sha256(want.encode()).hexdigest())


def test_contexts_of_seeds_discover_other_forms(make):
    rows = [(i, f"é please call me at +1 (826) 555-{4000 + i} today") for i in range(12)]
    rows += [(100, "please call me at 826-555-9999 today"), (101, "some other words 826-555-9999 here")]
    got = found(make, *rows)
    assert (got[100].n_found, got[100].n_phone) == (1, 0)
    assert got[100].spans == "phone:18:30"
    assert got[101].n_found == 0
    assert got[3].n_found == 0
    assert got[3].n_phone == 1


def test_contexts_that_are_no_evidence_discover_nothing(make):
    rows = [(i, f"the +1 (826) 555-{4000 + i} of") for i in range(3)] + [(100 + i, f"the {200 + i}-555-9999 of") for i in range(30)]
    assert all(r.n_found == 0 for r in found(make, *rows).values())


def test_loose_addresses_are_taken_whole():
    for local, domain in (("x" * 100 + "1", "y.org"), ("a", "b" * 80 + "." + "c" * 90 + ".d" * 8 + "ef.gh"), ("%_a.b", "x-y [dot] zz . org")):
        text = f"é ({local} [at] {domain}, {local}"
        start = text.index(local) + len(local) - len(local.lstrip("%_"))
        (s, k, e), *rest = pii.candidates(text, [])
        assert (k, text[s:e], rest) == (0, text[start : text.index(domain)] + (domain if ".d.d" not in domain else domain[: domain.index(".d.d")]), [])
    assert pii.candidates("[at] a.bc x[at] -- [at]", []) == []


def test_scoring_goes_on_until_it_stands_still(spark):
    edges = [("p0", f"s0{i}", True) for i in range(4)] + [("p0", "x1", False)]
    for j in range(1, 9):
        edges += [(f"p{j}", f"s{j}{i}", True) for i in range(3)] + [(f"p{j}", f"x{j}", False), (f"p{j}", f"x{j + 1}", False)]
    edges += [("weak", f"w{i}", i < 3) for i in range(9)]
    got = {r.pattern: r.confidence for r in pii.score_patterns(spark.createDataFrame(edges, "pattern string, instance string, seed boolean")).collect()}
    assert got == {f"p{j}": 1.0 for j in range(9)} | {"weak": 3 / 9}


def plain_find(rows):
    """The whole operator in plain loops over the text of each row: extra spans by row."""
    mentions = [(n, s, k, e, seed, re.sub(r"[^0-9a-z@.]", "", t[s:e].lower()), pii.patterns(t, s, k, e)) for n, t in enumerate(rows) for seed, some in ((True, plain(t)), (False, pii.candidates(t, plain(t)))) for s, k, e in some]
    edges: dict[str, dict[str, bool]] = {}
    for _, _, k, _, seed, value, own in mentions:
        for p in own:
            edges.setdefault(p, {})
            edges[p][f"{k}|{value}"] = edges[p].get(f"{k}|{value}", False) or seed
    live = {p: i for p, i in edges.items() if sum(i.values()) >= pii.SUPPORT and not all(i.values())}
    seeds = {x for i in live.values() for x, seed in i.items() if seed}
    taken = set(seeds)
    while True:
        share = {p: sum(x in taken for x in i) / len(i) for p, i in live.items()}
        more = set(seeds)
        for x in {x for i in live.values() for x in i} - seeds:
            doubt = 1.0
            for p, i in live.items():
                doubt *= 1 - min(share[p], 0.999) if x in i else 1
            more |= {x} if 1 - doubt >= pii.CONFIDENCE else set()
        if more == taken:
            break
        taken = more
    good = {p for p in live if share[p] >= pii.CONFIDENCE}
    return [sorted(plain(t) + sorted({(s, k, e) for m, s, k, e, seed, _, own in mentions if m == n and not seed and good & set(own)})) for n, t in enumerate(rows)]


def test_spans_are_those_of_plain_loops(make, rng):
    frames = ["please call me at {} today", "his number is {} or so", "write to {} now", "the code {} was sent", "{} and that is all"]
    values = [lambda: f"+1 (826) 555-{rng.randint(4000, 4040)}", lambda: f"826-555-{rng.randint(4000, 4040)}", lambda: f"u{rng.randint(1, 40)}@x.org", lambda: f"u{rng.randint(1, 40)} [at] x.org", lambda: f"10.0.0.{rng.randint(1, 40)}", lambda: f"999.0.0.{rng.randint(1, 40)}"]
    rows = [" ".join(rng.choice(frames).format(values[min(rng.randint(0, 7), 5)]()) for _ in range(rng.randint(0, 3))) for _ in range(150)]
    rows += rows[:10]  # rows that repeat
    want = plain_find(rows)
    got = {r.doc_id: r.spans for r in pii.find_personal_data(make(*enumerate(rows))).collect()}
    assert [got[i] for i in range(len(rows))] == [pii.shown(w) for w in want]
    assert sum(len(w) for w in want) > sum(len(plain(t)) for t in rows) + 10


def test_long_values_and_words_are_told_apart_by_their_ends(make):
    same, gap = "x" * 100, " " * 300
    rows = [(i, f"{same}{i} mail {gap} me{i % 2}{same}@y.org {gap} {same}0 end") for i in range(4)]
    got = {tuple(p) for _, t in rows for s, k, e in pii.base_spans(t) for p in [pii.patterns(t, s, k, e)]}
    assert len(got) == 4
    assert len({p[1] for p in got}) == 1
    scanned = pii.scan(make(*rows)).collect()
    assert len({m.value for r in scanned for m in r.mentions}) == 2


def test_edge_cases(nasty, empty):
    got = pii.find_personal_data(nasty).collect()
    assert len(got) == nasty.count()
    assert all(r.spans == "" for r in got)
    assert pii.find_personal_data(empty).count() == 0


@pytest.mark.parametrize("text", ["a@b.c " * 3000])
def test_long_text(make, text):
    assert found(make, (1, text))[1].n_email == 3000
