import random
import re
import time
from hashlib import sha256

from clipwright.llm.pii import report

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
SCHEMA = "doc_id long, text string, spans int, base string"


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "card" and not (14 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def check(spark, texts):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], SCHEMA).repartition(4)
    got = {r.doc_id: r for r in report(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = base(t)
        assert got[i].base_sha256 == sha256(",".join(want).encode()).hexdigest(), (t or "")[:300]
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(s.startswith(k) for s in want) for k in PLAIN]
        assert set(want) <= set(got[i].spans.split(","))
    return got


def test_base_matches_plain_patterns(spark):
    rnd = random.Random(4)
    texts = [None, "", "plain words only", "a@b.c_d@e.f x@y", "a@b@c.d e@f..g 日本x@é.com ñ a.b@c-d.e-f.g", "1.2.3.4.5.6.7.8 256.1.1.1 000.001.02.255 0000.0.0.0 1.2.3 99999999999999999999.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111112 4111  1111", "+1 (988) 555-2485 +1-2 +12 345 678 90 12 345 +", "𝔘𝔘 a@b.co 𝔘 +1 (988) 555-2485"]
    alphabet = ["0", "1", "4", "55", "255", ".", ".", "@", "-", " ", "+", "a", "b.c", "(", ")", "_", "%", "\n", "é", "𝔘", "4111111111111111"]
    texts += ["".join(rnd.choices(alphabet, k=rnd.randint(1, 60))) for _ in range(1500)]
    texts += ["a" * 10_000, "1" * 10_000, "1." * 30_000, "+1" + "(" * 200_000, "x@y.z " * 5_000, "a@" * 10_000, "12 " * 60_000, "@" * 100_000]
    check(spark, texts)


def test_trusted_contexts_add_identifiers(spark):
    rnd = random.Random(1)
    texts = [f"note {i} please write to user{i}@mail.example.com today and {rnd.choice('xyz')} more" for i in range(30)]
    texts += ["we say please write to secret.id77 today", "a clean text about version 2.0 of it", "released under version 2.0 today", "please write to you today", "write to agent-9000x today"]
    got = check(spark, texts)
    text = texts[30]
    start = text.index("secret")
    assert got[30].spans == f"email:{start}:{start + len('secret.id77')}"
    assert [got[i].spans for i in (31, 32, 33)] == ["", "", ""]
    start = texts[34].index("agent")
    assert got[34].spans == f"email:{start}:{start + len('agent-9000x')}"


KINDS = list(PLAIN)


def candidates(text, seeds):
    """Shaped runs apart from the seeds, plainly: words with a digit or an at sign, joined over single spaces."""
    runs = []
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        if re.search("[0-9@]", m[0]):
            if runs and runs[-1][1] + 1 == m.start() and text[m.start() - 1] == " ":
                runs[-1][1] = m.end()
            else:
                runs.append([m.start(), m.end()])
    clash = lambda a, b: any(s < b and e > a for s, _, e in seeds)
    for a, b in runs:
        if not clash(a, b) and b - a <= 64:
            yield a, b
        else:
            for m in re.finditer(r"[^\x20]+", text[a:b]):
                if re.search("[0-9@]", m[0]) and not clash(a + m.start(), a + m.end()):
                    yield a + m.start(), a + m.end()


def contexts(text, start, end):
    fold = lambda t: re.sub("[0-9]", "0", t.lower())
    left = re.search(r"[\x20\x09-\x0D]([^\x20\x09-\x0D]+[\x20\x09-\x0D]+[^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", (" ^ " + text[:start])[-128:])
    right = re.search(r"^[^\x20\x09-\x0D]*[\x20\x09-\x0D]+([^\x20\x09-\x0D]+)[\x20\x09-\x0D]", (text[end:] + " ")[:128])
    left = " ".join(fold(left[1]).split()) if left else ""
    return [x for x in (left and "after " + left, left and right and f"around {left.split()[-1]} _ {fold(right[1])}") if x]


def bootstrapped(texts, rounds=3, trust=0.8, support=4, doubt=0.5):
    """All spans of each text, by walking the pattern-instance graph."""
    spans, rest, graph, kind_of = [], [], {}, {}
    for text in texts:
        seeds = [(int(s.split(":")[1]), KINDS.index(s.split(":")[0]), int(s.split(":")[2])) for s in base(text)]
        spans.append({(a, k, b) for a, k, b in seeds})
        rest.append(list(candidates(text, seeds)))
        for a, b, k in [(a, b, k) for a, k, b in seeds] + [(a, b, None) for a, b in rest[-1]]:
            for pattern in contexts(text, a, b):
                graph.setdefault(pattern, set()).add(text[a:b].lower())
                if k is not None:
                    kind_of.setdefault(text[a:b].lower(), {})[k] = 1.0
    seeds, scores = kind_of, dict(kind_of)
    for _ in range(rounds):
        trusted = {}
        for pattern, whats in graph.items():
            if len(whats) >= support:
                known = [w for w in whats if w in scores]
                for k in range(4):
                    mass = sum(scores[w].get(k, 0) for w in known)
                    score = mass / (len(known) + doubt * (len(whats) - len(known)) + 1)
                    if score >= trust and mass >= support:
                        trusted.setdefault(pattern, {})[k] = score
        scores = dict(seeds)
        for pattern, kinds in trusted.items():
            for w in graph[pattern]:
                if w not in seeds:
                    mine = scores.setdefault(w, {})
                    for k, x in kinds.items():
                        mine[k] = max(mine.get(k, 0), x)
    for text, found, own in zip(texts, spans, rest):
        for a, b in own:
            best = max(((x, -k) for p in contexts(text, a, b) for k, x in trusted.get(p, {}).items()), default=None)
            if best:
                found.add((a, -best[1], b))
    return [",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(s)) for s in spans]


def test_learned_spans_match_a_plain_walk(spark):
    rnd = random.Random(9)
    identifier = [lambda: f"u{rnd.randrange(60)}@mail.example.com", lambda: f"10.0.{rnd.randrange(9)}.{rnd.randrange(200)}", lambda: f"+1 ({rnd.randrange(200, 900)}) 555-{rnd.randrange(1000, 9999)}", lambda: f"id{rnd.randrange(40)}", lambda: f"0{rnd.randrange(40)} 7946 0958", lambda: "7" * 70]
    leads = ["write to", "host is", "call me", "see page", "now\tor \n", "x" * 130 + " on"]
    texts = []
    for i in range(260):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            lead = rnd.randrange(len(leads))
            pick = identifier[lead] if lead < 3 and rnd.random() < 0.85 else rnd.choice(identifier)
            parts.append(f"{leads[lead]} {pick()} {rnd.choice(['today', 'or', 'u7@mail.example.com', '44'])}")
            if rnd.random() < 0.3:
                parts.append(" ".join(rnd.choices(["plain", "words", "go"], k=rnd.choice([1, 70, 130]))))
        texts.append((" " * (rnd.random() < 0.2)) + " ".join(parts))
    want = bootstrapped(texts)
    got = check(spark, texts)
    assert [got[i].spans for i in range(len(texts))] == want
    assert sum(len(w.split(",")) > len(base(t)) for w, t in zip(want, texts) if w) > 20


def test_hot_context_and_a_text_of_many_spans(spark):
    """A third of the rows share a context, a third an identifier; one text holds 50,000 seeds and as many other words."""
    texts = [f"mail {i}: write to user{i}@mail.example.com now" for i in range(1000)] + ["the code is 4711 here"] * 1000 + [f"write to agent-{i}x now" for i in range(20)]
    texts.append(" ".join(f"a{i}@b.co and {i} or" for i in range(50_000)))
    began = time.time()
    got = check(spark, texts)
    assert time.time() - began < 300
    assert got[1].spans and all(got[i].spans == "" for i in range(1000, 2000)) and all(got[i].spans.startswith("email:9:") for i in range(2000, 2020))
    assert got[2020].n_email == 50_000


def test_empty(spark):
    assert report(spark.createDataFrame([], SCHEMA)).collect() == []
