"""Base counts and the language model against plain dictionaries."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from opinara.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
    )


def test_base_counts_on_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    got = {r.doc_id: r for r in quality.apply_rules(docs).collect()}
    for row in docs.collect():
        mine, expected = got[row.doc_id], base(row.text)
        assert (mine.n_words, mine.word_chars, mine.n_symbols, mine.n_dup_lines, mine.n_repeat_words) == expected
        assert mine.base_failed == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])
        assert not (mine.kept and mine.base_failed)


def test_base_counts_on_random_text():
    dice = random.Random(4)
    for _ in range(3000):
        text = "".join(dice.choice(["a ", "b ", "c\n", "\n", " \t", "a b c d e ", "#", "<b>\x0b", "é\x1c", "d "]) for _ in range(dice.randint(0, 40)))
        words = WORD.findall(text)
        assert (len(words), *quality.base_counts(text, words)) == base(text)


class Plain:
    """Modified Kneser-Ney over strings, straight from its definition."""

    def __init__(self, words, order):
        self.order, raw = order, [Counter() for _ in range(order + 1)]
        for word, count in words.items():
            marked = ("<", *word, ">")
            for n in range(1, order + 1):
                for end in range(max(n, 2), len(marked) + 1):
                    raw[n][marked[end - n : end]] += count
        self.a = [Counter() for _ in range(order + 1)]
        for n in range(1, order + 1):
            for gram, count in raw[n].items():
                if n == order or gram[0] == "<":
                    self.a[n][gram] = count
            if n < order:
                for gram in raw[n + 1]:
                    self.a[n][gram[1:]] += 1
        self.discounts, self.sums, self.left = [None], defaultdict(int), defaultdict(float)
        for n in range(1, order + 1):
            times = Counter(self.a[n].values())
            self.discounts.append(quality._discounts([times[k] for k in (1, 2, 3, 4)]))
            for gram, count in self.a[n].items():
                self.sums[gram[:-1]] += count
                self.left[gram[:-1]] += self.discounts[n][min(count, 3)]
        self.base = 1 / (len(self.a[1]) + 1)

    def log_probability(self, word):
        marked, total = ("<", *word, ">"), 0.0
        for end in range(2, len(marked) + 1):
            p = self.base
            for n in range(1, min(self.order, end) + 1):
                gram = marked[end - n : end]
                if self.sums[gram[:-1]]:
                    count = self.a[n][gram]
                    kept = max(count - self.discounts[n][min(count, 3)], 0)
                    p = (kept + self.left[gram[:-1]] * p) / self.sums[gram[:-1]]
            total += math.log(p)
        return total


@pytest.mark.parametrize("order", [2, 4])
def test_model_equals_the_plain_one(spark, order):
    dice = random.Random(order)
    texts = [" ".join("".join(dice.choice("abcdeé日") for _ in range(dice.randint(1, 6))) for _ in range(60)) for _ in range(8)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = quality.fit(quality.documents_by_language(docs, "doc_id", "text", "lang"), order, 40)
    plain = Plain(Counter(w for t in texts for w in WORD.findall(t)), order)
    words = ["a", "abc", "日é", "zzz", "abcdeabcde", *texts[0].split()]
    got = model.log_probability(words, "x")
    assert got == pytest.approx([plain.log_probability(w) for w in words], rel=1e-9)


def test_probabilities_of_a_context_sum_to_one(spark):
    docs = spark.createDataFrame([(1, "aab abb bab aba bbb ab ba aa", "x")], "doc_id long, text string, lang string")
    plain = Plain(Counter("aab abb bab aba bbb ab ba aa".split()), 3)
    model = quality.fit(quality.documents_by_language(docs, "doc_id", "text", "lang"), 3, 40)
    assert model.base == plain.base == 1 / 4
    # One-letter steps after "a": the words "a" + c differ in what follows c, so sum the plain steps.
    assert model.log_probability(["ab"], "x")[0] == pytest.approx(plain.log_probability("ab"))


def test_noise_is_rejected_and_language_matters(spark):
    dice = random.Random(8)
    texts = lambda letters, n: [" ".join("".join(dice.choice(letters) for _ in range(4)) for _ in range(80)) for _ in range(n)]
    rows = [(i, t, "one") for i, t in enumerate(texts("abcd", 40))] + [(100 + i, t, "two") for i, t in enumerate(texts("wxyz", 40))]
    rows += [(200, texts("wxyz", 1)[0], "one"), (201, texts("!?;:+=", 1)[0], "two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in quality.apply_rules(docs).collect()}
    assert sorted(i for i, k in kept.items() if not k) == [200, 201]


def test_odd_rows(spark):
    rows = [(1, None, "en", 0), (2, "", None, 0), (None, "one two three four five six seven eight nine ten eleven", None, 1), (3, " \n\t", "en", 2), (3, " \n\t", "en", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, middle int")
    got = sorted((r.doc_id or -1, r.n_words, r.base_failed, r.kept) for r in quality.apply_rules(docs).collect())
    assert got == [(-1, 11, False, True), (1, 0, True, False), (2, 0, True, False), (3, 0, True, False), (3, 0, True, False)]
    assert quality.apply_rules(docs.limit(0)).count() == 0


def test_different_grams_keep_their_own_counts():
    """Cut to 21 bits, 200,000 hashes fell into some 190,000 slots."""
    import numpy as np

    hashes = quality.kernels.mix(np.arange(200_000, dtype=np.uint64))
    for n in range(quality.ORDER + 1):
        assert len(np.unique(quality.slots(hashes, n, quality.SLOT_BITS))) == 200_000


def test_a_model_too_large_to_send_gives_the_same(spark, small_dir, monkeypatch):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.union(docs.limit(5)).union(spark.createDataFrame([(None, None, None), (-1, "", "en")], docs.schema))
    rows = lambda: sorted(map(tuple, quality.apply_rules(docs).collect()), key=lambda r: (r[0] or 0, str(r[:8])))
    sent = rows()
    monkeypatch.setattr(quality, "MODEL_ENTRIES", 0)
    joined = rows()
    assert [r[:8] for r in joined] == [r[:8] for r in sent]
    assert [r[8] for r in joined if r[8] is not None] == pytest.approx([r[8] for r in sent if r[8] is not None], rel=1e-9)


def test_words_of_bytes_part_at_the_blanks_of_the_rules_only():
    dice = random.Random(7)
    letters = "ab#|\x1c\x1d\x1e\x1f\x85\xa0 　é€😀" + " \t\n\x0b\x0c\r" * 2
    for _ in range(500):
        text = "".join(dice.choices(letters, k=dice.randrange(60)))
        data = text.encode()
        assert (len(data.split()), *quality.byte_counts(data, data.split(), len(text))) == base(text)
