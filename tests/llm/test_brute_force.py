"""Models, ratios and license matches recomputed one by one, without Spark."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from linkweave.llm import license_scan, lm_score, quality_model, quality_rules

WORD = r"[^\x20\x09-\x0D]+"


def prose(seed, n, letters="abcdefgh"):
    chance = random.Random(seed)
    return " ".join("".join(chance.choices(letters, k=chance.randint(1, 7))) for _ in range(n))


def bucket(end, begin=None, buckets=quality_rules.BUCKETS):
    """The hash of one or two strings that Spark has, as a bucket."""
    code = xxhash.xxh64_intdigest(end.encode(), seed=42)
    if begin is not None:
        code = xxhash.xxh64_intdigest(begin.encode(), seed=code)
    return (code - (1 << 64) * (code >> 63)) % buckets


def grams(text):
    words = re.findall(WORD, text or "")
    for word, after in zip(words, [*words[1:], ""], strict=False):
        yield bucket(word[-3:])
        yield bucket(word[-3:], after[:2])


def ratios(texts, trusted, prior):
    """Mean log-likelihood ratio of each (doc_id, text), None without words."""
    every = collections.Counter(g for _, t in texts for g in grams(t))
    own = collections.Counter(g for d, t in texts if d in trusted for g in grams(t))
    n_all, n_own = sum(every.values()), sum(own.values())
    table = {
        g: math.log((own[g] + prior * n / n_all) / (n_own + prior) / (n / n_all)) if n_own else 0.0
        for g, n in every.items()
    }
    found = []
    for _, text in texts:
        logs = [table[g] for g in grams(text)]
        found.append(sum(logs) / len(logs) if logs else None)
    return found


def test_likelihood_ratios(spark, docs):
    texts = [(n, prose(n, 30 + n, "abcd" if n % 3 else "#XYé漢")) for n in range(30)]
    texts += [(40, None), (41, ""), (42, "one"), (1, texts[1][1]), (1, "other rows of an id"), (None, prose(7, 80))]
    trusted = {n for n in range(0, 30, 2)} | {1}
    ids = spark.createDataFrame([(n,) for n in [*trusted, None]], "doc_id bigint")
    for prior in (500, quality_rules.PRIOR):
        judged = quality_rules.quality_rules(docs(texts), ids, prior=prior).collect()
        wanted = collections.defaultdict(list)
        for (doc_id, text), llr in zip(texts, ratios(texts, trusted, prior), strict=True):
            wanted[doc_id, text].append(llr)
        assert len(judged) == len(texts)
        for r in judged:
            llr = wanted[r.doc_id, r.text][0]
            assert (r.llr is None) == (llr is None)
            assert llr is None or r.llr == pytest.approx(llr, abs=1e-9)
            assert r.kept == (not r.base_failed and llr is not None and r.llr >= quality_rules.THRESHOLD)


def containment(words, template):
    """Share of the template's three-word shingles in a stretch of words."""
    sets = [{tuple(w[k : k + 3]) for k in range(len(w) - 2)} for w in (words, template)]
    return len(sets[0] & sets[1]) / len(sets[1])


def plain(text):
    return [w for w in (re.sub(r"[\W_]+", "", w.lower()) for w in re.findall(WORD, text)) if w]


def test_every_license_match_is_found(docs):
    """Notices with words changed, dropped and put in, against all stretches of their length."""
    chance = random.Random(4)
    templates = [plain(text) for _, text in license_scan.NOTICES]
    rows = []
    for n in range(120):
        words = license_scan.NOTICES[n % len(templates)][1].split()
        for _ in range(n % 7):
            at = chance.randrange(len(words))
            kind = chance.randrange(3)
            if kind == 0:
                words[at] = "other"
            elif kind == 1 and len(words) > 4:
                del words[at]
            else:
                words.insert(at, "new")
        rows.append((n, f"{prose(n, n % 50)} {' '.join(words)} {prose(n + 500, 20)}"))
    found = collections.defaultdict(set)
    for r in license_scan.scan_licenses(docs(rows)).collect():
        found[r.doc_id].add(r.template)
        stretch = re.findall(WORD, rows[r.doc_id][1])[r.first_word : r.first_word + r.n_words]
        assert containment(plain(" ".join(stretch)), templates[r.template]) >= 0.8
    wanted = 0
    for doc_id, text in rows:
        words = plain(text)
        for number, template in enumerate(templates):
            size = len(template)
            if not set(words) & set(template):
                continue
            places = range(max(1, len(words) - size + 1))
            if any(containment(words[k : k + size], template) >= 0.8 for k in places):
                wanted += 1
                assert number in found[doc_id], (doc_id, number)
    assert wanted > 60


def contexts(texts, index):
    """Sums of neighbours' index vectors, word by word."""
    sums = np.zeros((quality_model.FORMS, quality_model.SIZE))
    for forms in texts:
        for at, form in enumerate(forms):
            for step in range(1, quality_model.REACH + 1):
                for other in (at - step, at + step):
                    if 0 <= other < len(forms):
                        sums[form] += index[forms[other]]
    return sums


def test_context_vectors_in_slices(monkeypatch):
    index = quality_model.index_vectors()
    chance = np.random.default_rng(3)
    texts = [chance.integers(0, 50, n) for n in (0, 1, 2, 3, 4, 5, 7, 8, 9, 64, 201)]
    wanted = contexts(texts, index)
    for size in (1, 2, 3, 4, 8, 1 << 16):
        monkeypatch.setattr(quality_model, "SLICE", size)
        assert (quality_model.context_sums(texts, index) == wanted).all()


def test_pooled_vectors_and_network():
    chance = np.random.default_rng(5)
    vectors = chance.normal(size=(quality_model.FORMS, 6)).astype(np.float32)
    forms = chance.integers(0, quality_model.FORMS, 40)
    text = "a b\n\nc\na b\n"
    found = quality_model.pooled(forms, text, vectors)
    assert found[:6] == pytest.approx(np.mean([vectors[f] for f in forms], axis=0), abs=1e-5)
    assert found[6:] == pytest.approx(
        [math.log(41) / 10, len(set(forms)) / 40, np.mean(forms[1:] == forms[:-1]), 2 / 3], abs=1e-6
    )
    x, y = chance.normal(size=(60, 10)), (chance.random(60) > 0.5).astype(float)
    net = quality_model.fit_network(x, y)
    for row, score in zip(x, net.scores(x), strict=True):
        hidden = [
            math.tanh(sum((row[i] - net.mean[i]) / net.scale[i] * net.first[i, j] for i in range(10)) + net.first_bias[j])
            for j in range(quality_model.HIDDEN)
        ]
        logit = sum(h * w for h, w in zip(hidden, net.second, strict=True)) + net.second_bias
        assert score == pytest.approx(1 / (1 + math.exp(-logit / net.temperature)), abs=1e-9)


def test_a_repeated_labelled_id_is_learned_from_once(spark, docs, monkeypatch):
    seen = []
    plain_fit = quality_model.fit_network
    monkeypatch.setattr(quality_model, "fit_network", lambda x, y: seen.append(len(y)) or plain_fit(x, y))
    labelled = [n for n in range(40) if not held_out(n, 4, 2)]
    labels = spark.createDataFrame([(n, n % 2) for n in labelled], "doc_id bigint, quality int")
    rows = [(n, prose(n, 20)) for n in range(40)] + [(labelled[0], prose(99, 5)), *[(labelled[0], "same")] * 300]
    assert quality_model.score_quality(docs(rows), labels, limit=len(labelled)).count() == len(rows)
    assert seen == [len(labelled)]


def held_out(doc_id, modulus, value):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == value


def softmax(scores):
    e = [math.exp(s - max(scores)) for s in scores]
    return [x / sum(e) for x in e]


def test_language_model_scores(docs, monkeypatch):
    """The score of each text from the weights and from plain counts, token by token."""
    kept = {}
    plain_train = lm_score.train

    def train(stored, vocabulary, rounds):
        kept["model"] = vocabulary, plain_train(stored, vocabulary, rounds)
        return kept["model"][1]

    monkeypatch.setattr(lm_score, "train", train)
    common = prose(1, 60).split()
    chance = random.Random(8)
    texts = [(n, " ".join(chance.choices(common, k=chance.randint(0, 40)))) for n in range(80)]
    texts += [(100, None), (101, ""), (102, "Words OF capital"), (None, texts[5][1]), (3, texts[3][1])]
    found = {}
    for r in lm_score.score_texts(docs(texts)).collect():
        found.setdefault((r.doc_id, r.n_tokens), set()).add(round(r.score, 4))
    vocabulary, weights = kept["model"]
    tokens = lambda text: [*(text or "").encode().lower().split(), None]
    counts = collections.Counter(
        w for d, t in texts if not held_out(d, 5, 1) for w in tokens(t)
    )
    endings = collections.defaultdict(lambda: [0, 0])
    own_leaves = set(vocabulary.top.tolist())
    codes = lm_score.WordCodes()
    for word, n in counts.items():
        if word is not None and codes[word] not in own_leaves:
            total = endings[codes[word] % lm_score.ENDINGS]
            total[0], total[1] = total[0] + n, total[1] + 1
    for doc_id, text in texts:
        own = tokens(text)
        coded = np.array([lm_score.END if w is None else codes[w] for w in own], np.int64)
        leaf = vocabulary.leaves(coded)
        hashes = lm_score.features(coded, leaf)
        score = 0.0
        for word, code, number, row in zip(own, coded, leaf, hashes, strict=True):
            group, member = divmod(int(number), lm_score.PER_CLASS)
            of_class, of_leaf = lm_score._rows(row[None, :], np.array([group]))
            p = softmax(weights.of_class[of_class[0]].sum(axis=0) + weights.class_bias)
            q = softmax(weights.of_leaf[of_leaf[0]].sum(axis=0) + weights.leaf_bias[group])
            score += math.log(p[group]) + math.log(q[member])
            if word is not None and int(code) not in own_leaves:
                n, types = endings[int(code) % lm_score.ENDINGS]
                score += math.log((counts[word] + 0.5) / (n + 0.5 * (types + 1)))
        score /= math.log(10)
        assert min(abs(score - s) for s in found[doc_id, len(own)]) < 2e-3 + 1e-5 * abs(score)
