"""Kernels of the corpus operators against plain Python, without Spark."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from jornada.llm import (common, decontaminate, html_extract, katz, language_id, near_dup, pii,
                         rule_ensemble, simple8b, token_store)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = ["", None, " ", "One", "one  TWO\tone", "É é\x0bx y", "a b c a b c", "x" * 5000, "tail "]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.mark.parametrize("limit", [1, 7, 1 << 20])
def test_word_hashes_follow_words(limit):
    seen, got = {}, []
    for lo, hi, offsets, data in common.text_slices(pa.array(TEXTS), limit):
        hashes, first = common.word_hashes(offsets, data)
        got += [hashes[a:b].tolist() for a, b in zip(first, first[1:])]
    assert [len(g) for g in got] == [len(words(t)) for t in TEXTS]
    for hashes, text in zip(got, TEXTS):
        for h, w in zip(hashes, words(text)):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("high", [1, 2, 100, 50_257, 2**31, 2**60, 2**63])
@pytest.mark.parametrize("n", [0, 1, 59, 60, 61, 240, 241, 3000])
def test_simple8b_round_trip(high, n):
    v = np.random.default_rng(n).integers(0, high, n, dtype=np.uint64)
    assert (simple8b.decode(simple8b.encode(v)) == v).all()


def test_simple8b_escapes():
    v = np.array([0] * 300 + [2**60 - 1, 2**60, 2**64 - 1, 2**60 - 1, 2**60 - 1, 7], np.uint64)
    assert (simple8b.decode(simple8b.encode(v)) == v).all()
    ids = np.array([5, 50_000, 0, 0, 1], np.uint16)
    assert (simple8b.decode(simple8b.encode(ids)) == ids).all()


def test_pieces_encode_like_whole_texts():
    from tokenizers import Tokenizer
    path = token_store.default_vocabulary()
    whole = Tokenizer.from_file(path)
    rng = random.Random(2)
    texts = ["don't 's we'll", "a \n b", "\n\nab\n\n c", "x_y 1 23 4a", " lead", "end ", "日本 語 é́  a"]
    texts += ["".join(rng.choice("ab é'*\n\t1_ ĉ .  ") for _ in range(rng.randint(1, 30))) for _ in range(500)]
    encode = token_store.PieceEncoder(path)
    assert [x.tolist() for x in encode(texts)] == [
        whole.encode(t, add_special_tokens=False).ids for t in texts]


def _edit_search(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(last + (c != d), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_myers_equals_dynamic_programming():
    rng = random.Random(3)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))
        best = _edit_search(p, t)
        hit = decontaminate.myers(p, t, len(p))
        assert (hit[0] if hit else len(p)) == best


def test_matcher_finds_every_occurrence_within_budget():
    rng = random.Random(4)
    letters = "abcdefghijklmnop "
    items = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(40, 120)))) for i in range(20)]
    m = decontaminate.Matcher([*items, (99, "short one"), (98, None)])
    for item_id, text in items:
        form = list(decontaminate.normalise(text))
        budget = int(decontaminate.RATE * len(form))
        for _ in range(budget):
            form[rng.randrange(len(form))] = rng.choice(letters.strip())
        host = decontaminate.normalise("some words before " + "".join(form) + " and after")
        found = {i: d for i, d, *_ in m.search(host)}
        assert found.get(item_id, 99) <= budget
    assert not list(m.search(decontaminate.normalise("nothing of that kind is in here at all")))
    assert [i for i, *_ in m.search(decontaminate.normalise("Short  ONE!"))] == [99]


def test_sketch_estimates_similarity_and_merges():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    for shared in (1800, 1000):
        other = np.concatenate((base[:shared], rng.integers(0, 2**63, 2000 - shared, dtype=np.uint64)))
        a, b = near_dup.registers(base), near_dup.registers(other)
        j = shared / (4000 - shared)
        got = near_dup.estimate(a[None], b[None], np.array([2000]), np.array([2000]))[0]
        assert abs(got - j) < 0.13
        both = near_dup.registers(np.union1d(base, other))
        assert (near_dup.merge(a, b) == both).all()


def test_html_blocks_and_references():
    page = ("<html><head><title>T</title><script>var t='</p>';</script></head><body><nav><a>Home</a></nav>"
            "<div class='ad'>Buy</div><article><h1>Head &amp; co</h1><p>One <b>tw</b>o\n three<p>four"
            "<aside>side</aside><div class=comments><p>first!</p></div></article><footer>&copy; x</footer>")
    weights = {}
    assert html_extract.extract(page, weights) == "Head & co One two three four"
    assert html_extract.extract("", weights) == "" and html_extract.extract("<p></p>", weights) == ""
    assert html_extract.extract("plain a < b", weights) == "plain a < b"
    assert html_extract.extract("<article><p>cut off</p><p cla", weights) == "cut off"


def test_html_region_is_chosen_by_the_weights():
    body = "<p>" + "long body text " * 20 + "</p>"
    page = f"<body><nav>menu</nav><article><h1>Head</h1>{body}</article><footer>end</footer></body>"
    weights = html_extract.weights_of({k: 1000 * n for k, n in html_extract.count_kinds(page).items()})
    text = "long body text " * 19 + "long body text"
    assert html_extract.extract(page, weights) == f"Head {text}"
    # without the marks, with teasers marked beside the body, and in two parts around a plain run
    assert html_extract.extract(page.replace("article", "div"), weights) == f"Head {text}"
    teasers = f"<body><article><p>one</p></article><div>{body}</div><article><p>two</p></article></body>"
    assert html_extract.extract(teasers, weights) == text
    parts = f"<body><article>{body}</article>and so on<article>{body}</article></body>"
    assert html_extract.extract(parts, weights) == f"{text} and so on {text}"


def test_html_keeps_text_beside_role_words():
    body = "kept " * 30
    page = lambda attrs: html_extract.extract(f"<body><div {attrs}><p>{body}</p></div></body>", {})
    for attrs in ('title="a hidden gem"', 'class="text comments-open"', 'class="content has-sidebar"', "data-hidden=1",
                  'title="display: none"', 'alt="class=ad"', "id=addendum", 'aria-hidden="false"', "class="):
        assert page(attrs) == body.strip(), attrs
    for attrs in ("hidden", 'hidden=""', "class='x ad'", "id=site-footer", 'class="comment-list"', 'role="navigation"',
                  'style="color:red; display : none"', 'aria-hidden="TRUE"', 'class="Cookie_Banner'):
        assert page(attrs) == "", attrs


def test_html_region_equals_brute_force():
    rng = random.Random(5)
    weights = {"w:p": 1.0, "w:li": 0.3, "p": -1.5, "a": -0.4, "w:p/x": -1.0}
    for _ in range(400):
        rows = []
        for _ in range(rng.randint(0, 14)):
            text = rng.choice([None, None, "a", "a b c", "a b c d e f g h i j k l m", " "])
            kind = rng.choice(["p", "a"]) if text is None else rng.choice(["w:p", "w:li"])
            rows.append((kind, text, rng.random() < 0.2, rng.random() < 0.5))

        def total(a, b):
            out, last = 0.0, None
            for kind, text, dropped, inside in rows[a:b]:
                n = 1 if text is None else len(text.split())
                if text is not None and n and not dropped:
                    out -= html_extract.CROSSING * (last is not None and last != inside)
                    last = inside
                out += 0.0 if dropped and inside else html_extract.weight(weights, kind, dropped) * n
            return out

        best = max((total(a, b) for a in range(len(rows)) for b in range(a, len(rows) + 1)), default=0.0)
        assert total(*html_extract.best_region(rows, weights)) == pytest.approx(max(best, 0.0))


def test_base_spans_equal_the_patterns():
    rng = random.Random(6)
    alphabet = "ab.@-+ 0123456789() "
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        expected = []
        for kind, pattern in pii.PATTERNS.items():
            for m in pattern.finditer(text):
                digits = re.sub("[^0-9]", "", m.group())
                ok = (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                      or kind == "card" and 13 <= len(digits) <= 19 and pii.luhn(digits)
                      or kind == "phone" and 9 <= len(digits) <= 15)
                if ok:
                    expected.append((kind, *m.span()))
        assert pii.base_spans(text) == expected


def test_skip_edges_carry_a_label_to_another_spelling():
    counts = Counter({("n:address", 1): 50, ("s", 1): 100, ("n:sr", 0): 50})
    crf = pii.Crf(counts)
    text = "mail ann.lee@site.example.com now, or ann.lee [at] site.example.com then"
    base = pii.base_spans(text)
    added = crf.added(text, base)
    assert [(k, text[a:b]) for k, a, b in added] == [("email", "ann.lee [at] site.example.com")]
    assert crf.added("nothing 12345678 here", []) == []


@pytest.mark.parametrize("copies", [1, 1_000_000])
def test_added_spans_do_not_depend_on_the_size_of_the_table(copies):
    texts = ["call +1 555 123 4567 or (555) 123-4567 today", "call +1 555 123 4567 or 555-123-4567",
             "order 555-987-6543 and 555-222-3333", "host 10.0.0.1, card 4111 1111 1111 1111", "+44 20 7946 0958"]
    counts = sum((pii.count_features(t) for t in texts), Counter())
    crf = pii.Crf({k: n * copies for k, n in counts.items()})
    added = [[(k, t[a:b]) for k, a, b in crf.added(t, pii.base_spans(t))] for t in texts]
    assert added == [[("phone", "(555) 123-4567")], [("phone", "555-123-4567")], [], [], []]


def test_good_turing_discounts_leave_mass():
    for histogram in ({1: 100, 2: 40, 3: 20, 4: 12, 5: 8, 6: 6}, {1: 3}, {}, {2: 5}):
        d = katz.discounts(histogram)
        assert len(d) == katz.K and all(0 < x < 1 for x in d)


def test_rules_separate_and_compile():
    rng = np.random.default_rng(7)
    x = rng.random((1500, len(rule_ensemble.NAMES)))
    y = ((x[:, 2] < 0.4) & (x[:, 3] < 0.7)).astype(float)
    rules = rule_ensemble.extract_rules(x, y)
    a = np.column_stack([rule_ensemble.fires(r, x) for r in rules]).astype(float)
    w, b = rule_ensemble.lasso_logistic(a, y)
    assert (((a @ w + b) > 0) == (y > 0)).mean() > 0.97
    assert (w == 0).any()
    sql = rule_ensemble.RuleModel([(rules[0], 0.5)], -1.0).sql()
    assert "CASE WHEN s_" in sql and math.isfinite(b)


def test_language_features_ignore_signs_and_case():
    def vec(t):
        (_, _, o, d), = common.text_slices(pa.array([t]))
        return language_id.features(o, d)[0]
    assert np.allclose(vec("the house is élan"), vec("THE#HOUSE IS ÉLAN"))
    assert not vec("12 !!").any()


def test_packed_keys_and_counts():
    rng = np.random.default_rng(3)
    top = np.iinfo(np.uint64).max
    for keys in ([], [0], [top], [0, top], rng.integers(0, top, 5000, dtype=np.uint64), range(300)):
        keys = np.unique(np.array(list(keys), dtype=np.uint64))
        assert (katz.unpack_keys(katz.pack_keys(keys)) == keys).all()
    for counts in ([], [0], [255, 256], [1 << 40, 3]):
        assert katz.unpack_counts(katz.pack_counts(np.array(counts, dtype=np.int64))).tolist() == counts


def test_encoder_equals_the_plain_tokenizer():
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(token_store.default_vocabulary())
    parts = [" ", "  ", "\n", "\n\n", "\t", "a", "foo", "Bär", "ñó", "'s", "can't", ".", "!?", "##", "\x00",
             "12", "3a", "_", "<|endoftext|>", "ª", "你"]
    rng = random.Random(11)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    encode = token_store.PieceEncoder(token_store.default_vocabulary())
    for at in range(0, len(texts), 200):
        some = texts[at:at + 200]
        for ids, text in zip(encode(some), some):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


def test_encoder_numbers_pieces_of_a_column_and_learns_units_once():
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(token_store.default_vocabulary())
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(3, 9))) for _ in range(200)]
    pieces = [w + mark for w in words for mark in ("", ",", ".", "!?", "-" + words[0], "\n" + words[1])]
    odd = ["", " ", "  a", "a ", "a  b", "a \x85b", "\n", "x\n y", "q" * 200 + " it's 12 你好", "<|endoftext|> a  b", None]
    texts = odd + [" ".join(rng.choices(pieces, k=60)) for _ in range(400)] + odd[::-1]
    column = pa.array(["skipped", *texts]).slice(1)
    encode = token_store.PieceEncoder(token_store.default_vocabulary())
    for _ in range(2):
        assert [ids.tolist() for ids in encode(column)] == [
            plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    # Words with and without the space before them, four marks and a line break, and
    # the few pieces of the odd texts: no entry for each of the 1,200 pieces.
    assert len(encode._slots) < 450
    assert max(map(len, encode._slots)) <= token_store.CACHE_LENGTH + 1
    assert [ids.tolist() for ids in encode([])] == []
