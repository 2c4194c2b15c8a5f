"""Packing, counting, scoring, language, toxicity and mixing, against brute force or held-out cases."""

import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from tests_prose import prose

from queuelake.llm import language_id, lm_scoring, packing, source_mixing, textbytes, token_counts, toxicity

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fold(i, n):
    return zlib.crc32(str(i).encode() if i is not None else b"") % n


def odd_texts():
    draw = random.Random(5)
    alphabet = "aZ09 .,'\n\t\r\x0b\x0c\x1c\x85\xa0 éßİçñ中文あ🙂́ا‍_-#"
    return ["".join(draw.choice(alphabet) for _ in range(draw.randrange(1, 60))) for _ in range(1500)] + [
        "it's we'll I'd they've", "<|endoftext|>", "a<|endoftext|> b <|endoftext|>", "   trailing   ", "x" * 3000, "\n\n \n", "１２３ ½ Ⅷ", ""
    ]


def test_encoder_equals_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.encoder("byte_bpe_50k")
    for text in odd_texts():
        assert encode.ids(text).tolist() == reference.encode(text, add_special_tokens=False).ids, repr(text)


def test_first_fit_decreasing_is_first_fit():
    draw = np.random.default_rng(2)
    lengths = draw.integers(1, 101, 700)
    sequence, offset = packing.first_fit_decreasing(lengths, 100)
    rooms = []
    for i in np.argsort(-lengths, kind="stable"):
        at = next((k for k, room in enumerate(rooms) if room >= lengths[i]), len(rooms))
        if at == len(rooms):
            rooms.append(100)
        assert (sequence[i], offset[i]) == (at, 100 - rooms[at])
        rooms[at] -= lengths[i]


@pytest.mark.parametrize("capacity,group_docs", [(1024, 8192), (64, 5)])
def test_packing_round_trip(as_docs, odd_rows, capacity, group_docs):
    rows = odd_rows + [(100 + i, " ".join(prose(i, 5 + 7 * (i % 40))), "en", "s") for i in range(150)]
    pieces = packing.pack_documents(as_docs(rows), capacity=capacity, group_docs=group_docs).collect()
    encode = packing.encoder("byte_bpe_50k")
    expected = Counter((i, (*encode.ids(t or "").tolist(), 0)) for i, t, *_ in rows)
    sequences, parts = {}, {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length and zlib.crc32(p.ids) == p.ids_crc32
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        parts.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, bytes(p.ids)))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    for (i, n), own in parts.items():
        texts = [k for k in expected if k[0] == i and len(k[1]) == n]
        copies = sum(expected[k] for k in texts)
        assert sum(len(b) for _, b in own) == 4 * n * copies
        by_start = {}
        for start, body in own:
            by_start.setdefault(start, set()).add(body)
        if len(texts) == 1:
            assert np.frombuffer(b"".join(next(iter(by_start[s])) for s in sorted(by_start)), "<u4").tolist() == list(texts[0][1])
    assert {(k[0], len(k[1])) for k in expected} == set(parts)


def test_token_counts(as_docs, odd_rows):
    vocabulary = set(token_counts.vocabulary()) | {bytes([b]) for b in range(256)}
    longest = max(map(len, vocabulary))

    def greedy(word):
        at = count = 0
        while at < len(word):
            at += next(n for n in range(min(longest, len(word) - at), 0, -1) if word[at : at + n] in vocabulary)
            count += 1
        return count

    rows = odd_rows + [(100 + i, t, "en", "s") for i, t in enumerate(odd_texts())]
    expected = Counter()
    for i, text, *_ in rows:
        pieces = [greedy(b" " + w) for w in WORD.findall((text or "").encode())]
        expected[i, len((text or "").encode()), len(pieces), sum(pieces), max(pieces, default=0)] += 1
    found = token_counts.count_tokens(as_docs(rows)).select("doc_id", "n_bytes", "n_words", "n_tokens", "longest_word_tokens")
    assert Counter(map(tuple, found.collect())) == expected


def test_automaton_goes_back():
    """Where the longest path ends without a piece, matching goes on behind the pieces already certain."""
    machine = token_counts.Automaton([b" a", b"b", b" abcdx", b"bc", b"cd", b"dy"])
    words = [b"abcd", b"abcdx", b"abcdy", b"abcbc"]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    assert machine.counts(data, ends - [len(w) for w in words], ends).tolist() == [3, 1, 3, 3]


def test_scores_and_base(as_docs, odd_rows):
    rows = odd_rows + [(100 + i, " ".join(prose(i, 120) + (["rareword"] * 30 if i % 9 == 0 else [])), "en", "s") for i in range(120)]
    words = {k: [*WORD.findall((t or "").encode().lower()), None] for k, (_, t, *_) in enumerate(rows)}
    count = Counter(w for k, own in words.items() if fold(rows[k][0], 10) for w in own)
    total = sum(count.values())
    found = lm_scoring.score_documents(as_docs(rows)).collect()
    expected = Counter()
    for k, own in words.items():
        base = sum(np.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in own)
        expected[rows[k][0], fold(rows[k][0], 10) == 0, len(own), sum(count[w] > 0 for w in own), total, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == expected
    assert all(np.isfinite(r.score) and r.score < 0 and r.bits_per_byte > 0 for r in found)
    held = [r for r in found if r.held_out and r.n_tokens > 100]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_spelling_is_a_distribution():
    """Over all next letters, the probabilities of the bits multiply to one; training makes the seen likelier."""
    words = pa.array([b"thing", b"think", b"thorn", b"other"] * 50, pa.binary())
    tables = np.zeros((len(lm_scoring.ORDERS), 2, lm_scoring._CELLS), np.uint32)
    letters = lm_scoring.Letters(words)
    for bit in range(7, -1, -1):
        cells, value = letters.cells(bit)
        for o, cell in enumerate(cells):
            np.add.at(tables[o], (value, cell), 1)
    mixer = lm_scoring.Mixer()
    one = np.exp(lm_scoring.spelling_cost(pa.array([bytes([b]) for b in range(1, 256)] + [b""], pa.binary()), tables, mixer))
    assert 0 < one.sum() <= 1 + 1e-9
    seen, other = lm_scoring.spelling_cost(pa.array([b"thing", b"zqxgk"], pa.binary()), tables, mixer)
    assert seen > other + 5


def test_known_words_are_mixed_with_the_word_before(as_docs):
    """A document of known words is likelier in the order that training documents have."""
    phrase = "one small river runs through seven green valleys".split()
    held = [i for i in range(400) if fold(i, 10) == 0][:2]
    rows = [(i, " ".join(phrase * 4), "en", "s") for i in range(200) if fold(i, 10)]
    rows += [(held[0], " ".join(phrase), "en", "s"), (held[1], " ".join(phrase[::-1]), "en", "s")]
    found = {r.doc_id: r for r in lm_scoring.score_documents(as_docs(rows)).collect()}
    straight, turned = (found[i] for i in held)
    assert straight.held_out and turned.held_out and straight.n_known == turned.n_known == straight.n_tokens
    assert abs(straight.base_score - turned.base_score) < 1e-9 and straight.score > turned.score + 3


def test_frequent_letters_have_few_bits():
    """Every letter has a code of its own after every letter, and prose takes half of eight bits a letter at most."""
    words = pa.array([w.encode() for k in range(30) for w in prose(k, 100)], pa.binary())
    follow = np.bincount(lm_scoring.Spelled(words).pair, minlength=257 * 256).reshape(257, 256)
    code = lm_scoring.Code(follow)
    assert np.allclose((0.5 ** code.size.reshape(257, 256)).sum(axis=1), 1)
    letters = lm_scoring.Letters(words, code)
    assert len(letters.of) < 4 * len(letters.letter)
    # The bits of a letter name it.
    for before in (256, ord("e"), 0):
        bits = [tuple(code.value[b : b + n]) for b, n in zip(code.base.reshape(257, 256)[before], code.size.reshape(257, 256)[before], strict=True)]
        assert len(set(bits)) == 256 and not any(a != b and b[: len(a)] == a for a in bits[:20] for b in bits)


def _model(rows):
    """Code, levels of counted bits and an untrained mixer, from the tokens of one slice."""
    data = [t.encode() for t in rows]
    low, offsets = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
    tokens = lm_scoring.Tokens(low, offsets)
    code = lm_scoring.Code(np.bincount(lm_scoring.Spelled(tokens.words).pair, minlength=257 * 256).reshape(257, 256))
    counts = np.zeros((len(lm_scoring.ORDERS), 2, lm_scoring._CELLS), np.uint32)
    pairs = lm_scoring.Pairs(lm_scoring.Letters(tokens.words, code), tokens.word, tokens.before)
    for o, cell in enumerate([*(c.take(pairs.at) for c in pairs.letters.alone()), pairs.cells()]):
        np.add.at(counts[o], (pairs.letters.value.take(pairs.at), cell), 1)
    return tokens, code, lm_scoring.levels(counts), lm_scoring.Mixer()


def test_pairs_worked_out_together_cost_what_each_costs():
    tokens, code, table, mixer = _model([" ".join(prose(k, 60)) for k in range(5)] + ["", "the the the"])
    mixer.weights += np.arange(mixer.weights.size, dtype=np.float32).reshape(mixer.weights.shape) / 1000
    cost = lambda words, word, before: lm_scoring.pair_cost(lm_scoring.Pairs(lm_scoring.Letters(words, code), word, before), table, mixer, mixer.logs())
    words, word, before, _, _ = next(tokens.chunks(1000))
    alone = [cost(words.slice(w, 1), np.zeros(1, np.int64), before[k : k + 1])[0] for k, w in enumerate(word[:40])]
    assert np.allclose(cost(words, word, before)[:40], alone, rtol=1e-6)
    assert sum(tokens.n) == len(tokens.row) and (tokens.word[tokens.pair()] == tokens.token).all()


def test_small_batches_become_one_block():
    """Spark's batches are smaller than a block: a word of many batches is posted, and worked out, once."""
    _, code, table, mixer = _model(["one two"])
    batch = lambda k: pa.record_batch({"doc_id": [2 * k, 2 * k + 1], "text": ["one two two", None if k % 2 else "one"], "held_out": [False, True]})
    posted = lm_scoring._postings(SimpleNamespace(value=(table, code)), mixer)(batch(k) for k in range(8))
    rows = pa.Table.from_batches(list(posted)).to_pylist()
    assert len({r["block"] for r in rows}) == 1 and [r["word"] for r in rows] == [b"one", b"two", b""]
    assert [np.frombuffer(r["rows"], np.uint16).tolist() for r in rows[:2]] == [[0, 1, 2, 4, 5, 6, 8, 9, 10, 12, 13, 14], list(range(0, 16, 2))]
    assert np.frombuffer(rows[1]["times"], np.uint32).tolist() == [2] * 8
    found = pa.ipc.open_stream(rows[2]["docs"]).read_all()
    assert found.column("doc_id").to_pylist() == list(range(16)) and found.column("held_out").to_pylist() == [False, True] * 8


def test_a_very_long_word_has_a_score():
    """Its chance is below the smallest double."""
    tokens, code, table, mixer = _model(["z" * 5 + "qxjkv" * 1000, "one two"])
    found = lm_scoring.document_scores(tokens, 2, np.zeros_like(table), code, mixer)
    assert np.isfinite(found).all() and found[0] < -400


def test_scores_without_training_rows(as_docs):
    held = [i for i in range(60) if fold(i, 10) == 0]
    found = lm_scoring.score_documents(as_docs([(i, "some words", "en", "s") for i in held])).collect()
    assert len(found) == len(held) and all(r.train_tokens == 0 and r.n_known == 0 and np.isfinite(r.score) for r in found)


def language_rows():
    stems = {"en": ["the", "ing", "and", "tion", "er"], "de": ["ung", "sch", "der", "keit", "ä"], "fr": ["eau", "que", "é", "oi", "le"]}
    return [(i, " ".join(prose(i, 20 + i % 30, stems[lang])), lang, "s") for i in range(240) for lang in [sorted(stems)[i % 3]]]


def test_language(as_docs, odd_rows):
    rows = language_rows() + [(1000, "Это совсем другой язык, и его модели не знают.", None, "s"), (1001, "123 ... !!!", "en", "s"), (1002, None, "de", "s"), (1003, "THE ING AND!", None, "s")]
    found = {r.doc_id: r for r in language_id.identify(as_docs(rows)).collect()}
    truth = {i: lang for i, _, lang, _ in language_rows()}
    held = [i for i in truth if fold(i, 3) == 1]
    assert all(found[i].held_out == (fold(i, 3) == 1) for i in found)
    assert np.mean([found[i].lang_pred == truth[i] for i in held]) > 0.97
    assert not any(found[i].rejected for i in truth)
    assert found[1000].rejected and found[1000].lang_pred in truth.values()
    assert [(found[i].lang_pred, found[i].score, found[i].rejected) for i in (1001, 1002)] == [("und", 0.0, True)] * 2
    assert found[1003].lang_pred == "en" and 0 <= found[1003].score <= 1
    assert language_id.identify(as_docs(odd_rows)).count() == len(odd_rows)


def test_language_without_labels(as_docs):
    found = language_id.identify(as_docs([(i, "text", None, "s") for i in range(9)])).collect()
    assert {(r.lang_pred, r.rejected) for r in found} == {("und", True)}


def test_kneser_ney_sums_to_one():
    text = "    the thing then that   "
    counts = Counter(text[i : i + 5] for i in range(len(text) - 4))
    letters = sorted(set(text))
    tables = language_id.kneser_ney(dict(counts), len(letters) + 1)
    scorer = language_id.Scorer({"langs": ["x"], "tables": [tables], "alphabet": len(letters) + 1})
    for context in ("    ", " the", "zzzz"):
        stream = np.array([ord(c) for x in [*letters, "q"] for c in context + x], np.uint64)
        at = np.arange(4, len(stream), 5)
        assert abs(np.exp(scorer._work_out(stream, at)).sum() - 1) < 1e-4


def test_network_gradients():
    words = toxicity.Words(*textbytes.utf8(pa.array(["some small words here", "and other ones"])))
    net = toxicity.Network(np.sort(words.hashes), 3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    token, live = toxicity._layout(words, np.arange(2))
    numbers, label = net.numbers(words), np.array([1.0, 0.0])

    def loss():
        x = net.logits(net.inputs(numbers, words.grams, words.begin, words.sizes), token, live)
        p = 1 / (1 + np.exp(-x))
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))

    grad, _ = net.gradients(net.inputs(numbers, words.grams, words.begin, words.sizes), token, live, label)
    for name in ("in_f", "in_b", "state_f", "state_b", "bias_f", "attend", "out"):
        flat, own = net.w[name].reshape(-1), np.asarray(grad[name]).reshape(-1)
        for k in (0, len(flat) // 2, len(flat) - 1):
            keep = flat[k]
            flat[k] = keep + 1e-2
            up = loss()
            flat[k] = keep - 1e-2
            slope = (up - loss()) / 2e-2
            flat[k] = keep
            assert abs(slope - own[k]) < 2e-3 + 0.05 * abs(slope), (name, k, slope, own[k])


def test_toxicity(spark, as_docs, odd_rows):
    draw = random.Random(11)
    rows, labels = [], []
    for i in range(600):
        words = prose(i, draw.randrange(5, 90))
        if i % 4 == 0:
            for _ in range(draw.randrange(1, 4)):
                words[draw.randrange(len(words))] = draw.choice(["vileword", "nastyone"]) + draw.choice(["", "s", "ed"])
        rows.append((2000 + i, " ".join(words), "en", "s"))
        labels.append((2000 + i, int(i % 4 == 0)))
    table = spark.createDataFrame([*labels, (2000, 1), (None, 1), (2001, None)], "doc_id bigint, toxic int")
    found = {(r.doc_id): r for r in toxicity.toxicity(as_docs(rows), table).collect()}
    truth = dict(labels)
    held = [i for i in truth if fold(i, 3) == 1]
    assert np.mean([found[i].predicted == truth[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.held_out == (fold(r.doc_id, 3) == 1) and r.predicted == int(r.score >= 0.7) for r in found.values())
    plain = toxicity.toxicity(as_docs(odd_rows), network=toxicity.train([], np.zeros(0, int))).collect()
    assert len(plain) == len(odd_rows) and all(r.score == 0 for r in plain if r.doc_id in (1, 2, 3))


def plain_probability(net, text):
    """The score of one text, word by word and window by window, with plain loops."""
    if not text:
        return 0.0
    lower = re.sub(rb"[A-Z]", lambda m: m.group().lower(), text.encode())
    words = re.findall(rb"[0-9a-z\x80-\xff]+", lower)
    if not words:
        return 0.0
    known = {int(h): i + 1 for i, h in enumerate(net.vocabulary)}
    w, h = {k: v.astype(float) for k, v in net.w.items()}, toxicity._HIDDEN
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def vector(word):
        one = toxicity.Words(np.frombuffer(word, np.uint8), np.array([0, len(word)]))
        framed = [0, 1, *word, 2, 0]
        cells = []
        for i in range(2, len(word) + 2):
            code = framed[i - 1] << 16 | framed[i] << 8 | framed[i + 1]
            cells.append(int(textbytes.mix(np.array([code], np.uint64))[0]) % toxicity._SHORT_CELLS)
            code = code << 16 | framed[i - 2] << 8 | framed[i + 2]
            cells.append(toxicity._SHORT_CELLS + int(textbytes.mix(np.array([code], np.uint64))[0]) % toxicity._LONG_CELLS)
        return np.concatenate([w["words"][known.get(int(one.hashes[0]), 0)], w["chars"][cells].sum(axis=0) / np.sqrt(len(cells))])

    logits = []
    start = 0
    while True:
        window = [vector(x) for x in words[start : start + toxicity.WINDOW]]
        states = {}
        for side, order in (("f", range(len(window))), ("b", range(len(window) - 1, -1, -1))):
            state, states[side] = np.zeros(h), {}
            for t in order:
                x, inner = window[t] @ w[f"in_{side}"] + w[f"bias_{side}"], state @ w[f"state_{side}"]
                z, r = sigmoid(x[:h] + inner[:h]), sigmoid(x[h : 2 * h] + inner[h : 2 * h])
                new = np.tanh(x[2 * h :] + r * inner[2 * h :])
                state = states[side][t] = z * state + (1 - z) * new
        both = np.array([np.concatenate([states["f"][t], states["b"][t]]) for t in range(len(window))])
        share = np.exp(both @ w["attend"])
        logits.append(share @ both / share.sum() @ w["out"] + w["out_bias"][0])
        if start + toxicity.WINDOW >= len(words):
            break
        start += toxicity.STRIDE
    logits = np.array(logits)
    toxic, clean = sigmoid(logits).sum() + 0.02, sigmoid(-logits).sum() + 0.02
    facts = [max(-15, min(15, logits.max())), np.log(toxic / clean), np.log(toxic), np.log(len(logits) + 1)]
    return sigmoid(np.dot(facts, net.pool[:-1]) + net.pool[-1])


def test_trained_network_against_plain_loops(spark, as_docs, odd_rows):
    draw = random.Random(3)
    texts, labels = [], []
    for i in range(240):
        words = prose(i, draw.randrange(5, 60))
        if i % 4 == 0:
            words[draw.randrange(len(words))] = draw.choice(["vileword", "nästy"]) + draw.choice(["", "s", "ed"])
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    net = toxicity.train(texts, np.array(labels), steps=60)
    rows = [(i, t[:6000] if t else t, x, s) for i, t, x, s in odd_rows] + [(100 + i, t, "en", "s") for i, t in enumerate(texts[:20])]
    found = toxicity.toxicity(as_docs(rows), network=net).collect()
    assert len(found) == len(rows)
    expected = Counter((i, round(plain_probability(net, t), 3)) for i, t, *_ in rows)
    near = sorted(expected.elements(), key=str)
    for row, (i, score) in zip(sorted(found, key=lambda r: str((r.doc_id, round(r.score, 3)))), near, strict=True):
        assert row.doc_id == i and abs(row.score - score) < 2e-3, (row, score)
    whole = toxicity.toxicity(as_docs(odd_rows), network=net).collect()
    assert len({r.score for r in whole if r.doc_id == 7}) == 1


def test_toxicity_by_the_share_of_odd_words():
    """Words that clean documents have now and then, too, and that no word of the vocabulary equals."""
    draw = random.Random(8)
    parts = ["ka", "lo", "mi", "ne", "ru", "sa", "te", "vo", "zi", "pa", "du", "go"]

    def text(toxic):
        size = draw.randrange(40, 400)
        words = ["".join(draw.choices(parts, k=draw.randrange(2, 5))) for _ in range(size)]
        for k in range(size):
            if toxic and draw.random() < 0.05:
                words[k] = "zigo" + "".join(draw.choices(parts, k=2))
        return " ".join(words)

    labels = np.array([int(i % 5 == 0) for i in range(1500)])
    texts = [text(x) for x in labels]
    net = toxicity.train(texts[:1200], labels[:1200], steps=900)
    found = [plain > 0.5 for plain in _scores(net, texts[1200:])]
    assert np.mean(np.array(found) == labels[1200:]) > 0.9


def _scores(net, texts):
    words = toxicity.Words(*textbytes.utf8(pa.array(texts)))
    return net.probability(net.score_windows(words), words.window_row, len(texts))[0]


def test_windows_cover_every_word():
    for n in (0, 1, 11, 24, 25, 36, 37, 100):
        words = toxicity.Words(*textbytes.utf8(pa.array([" ".join(f"w{i}" for i in range(n))])))
        covered = {k for f, s in zip(words.window_first.tolist(), words.window_size.tolist(), strict=True) for k in range(f, f + s)}
        assert covered == set(range(n)) and all(s > 0 for s in words.window_size)


@pytest.mark.parametrize("block_tokens", [1 << 20, 200])
def test_mixing(as_docs, odd_rows, block_tokens):
    rows = [(i, " ".join(prose(i, 10 + i % 17)), "en", "big" if i % 10 < 6 else f"s{i % 10}") for i in range(500)]
    found = source_mixing.mix(as_docs(rows), repetition_limit=2.0, block_tokens=block_tokens)
    assert set(as_docs(rows).columns) | {"mix_copy", "mix_block", "mix_place"} == set(found.columns)
    passes = Counter((r.source, r.doc_id) for r in found.collect())
    assert {i for _, i in passes} == {r[0] for r in rows}
    tokens = {r[0]: len(WORD.findall(r[1].encode())) + 1 for r in rows}
    total, mixed = Counter(), Counter()
    for i, _, _, source in rows:
        total[source] += tokens[i]
        mixed[source] += tokens[i] * passes[source, i]
    share = {s: n / sum(total.values()) for s, n in total.items()}
    low, high = min(share.values()), max(share.values())
    a = 1 - np.log(2.0) / np.log(high / low)
    for s in share:
        budget = total[s] * (share[s] / high) ** (a - 1)
        assert 0 <= mixed[s] - round(budget) < 30 or abs(mixed[s] - budget) < 1, (s, mixed[s], budget)
    odd = source_mixing.mix(as_docs(odd_rows), block_tokens=block_tokens)
    assert {r.doc_id for r in odd.collect()} == {r[0] for r in odd_rows} and odd.count() >= len(odd_rows)


@pytest.mark.parametrize("target", [0.3, 1.0, 1.09])
def test_mixing_to_entropy(spark, target):
    sources = spark.createDataFrame([("a", 700), ("b", 200), ("c", 100)], "_source string, tokens bigint")
    a = source_mixing.exponent(sources, None, target)
    weights = np.array([0.7, 0.2, 0.1]) ** a
    weights /= weights.sum()
    assert abs(-(weights * np.log(weights)).sum() - target) < 1e-6


@pytest.mark.parametrize("run", [packing.pack_documents, token_counts.count_tokens, lm_scoring.score_documents, language_id.identify, source_mixing.mix])
def test_no_rows(as_docs, run):
    assert run(as_docs([(1, "x", "en", "s")]).where("doc_id = 0")).count() == 0


def test_toxicity_no_rows(spark, as_docs):
    assert toxicity.toxicity(as_docs([(1, "x", "en", "s")]).where("doc_id = 0"), spark.createDataFrame([], "doc_id bigint, toxic int")).count() == 0


def test_documents_score_alike_whatever_lies_beside_them():
    """Logits of windows differ in their last digits between slices; the score of a document does not."""
    net = toxicity.Network(np.zeros(0, np.int64))
    net.pool = np.array([1.0, 0.5, 0.5, 0.1, -2.0])
    row = np.zeros(300, np.int64)
    logit = np.linspace(-3, 9, 300).astype(np.float32)
    scores = {float(net.probability(logit + np.float32(shift), row, 1)[0][0]) for shift in (0, 1e-7, -1e-7)}
    assert len(scores) == 1
