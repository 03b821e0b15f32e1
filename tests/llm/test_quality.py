import random
import re
import unicodedata
from collections import Counter

from ledgerline.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text or "")
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed)


def line_fails(x):
    n, bars = len(WORD.findall(x)), re.sub(r"(?<![^ \t(])\|[^| \t]+\|(?![^ \t,.;:)])", "", x).count("|")
    return (
        bars >= 3 and n < 4 * (1 + bars)
        or 10 * sum(c in "#*$%&|<>" for c in x) > len(x)
        or (x.upper() == x and x.lower() != x and len(x) >= 20)
        or bool(re.search(r"(?i)\b(" + "|".join(q.BOILERPLATE) + r")\b", x)) and n <= 20
        or (not any(unicodedata.category(c) == "Po" and c not in "#%&*@/\\" for c in x) and n >= q.UNPUNCTUATED_WORDS)
    )


def parts(line):
    if len(line) <= 300:
        return [line]
    return re.split("(?<=[.!?\u2026\u0964\u0965\u06d4\u061f\u1362])(?=[ \t])|(?<=[\u3002\uff01\uff1f])(?=.)", line)


def cleaned(text):
    good = [[p for p in parts(x) if not line_fails(p)] for x in (text or "").split("\n")]
    return "\n".join("".join(x) for x in good if x)


def kept(text):
    if base(text)[5]:
        return False
    lines = [parts(x) for x in (text or "").split("\n")]
    lost = sum(len(p) for x in lines for p in x if line_fails(p))
    return 100 * lost <= q.MAX_LOST * sum(len(p) for x in lines for p in x)


def corpus():
    rng = random.Random(3)
    vocab = ["a", "be", "é!", "ÀB", "😀", "x|", "#t", "of", "$$$", "The.", "a|b|c|d"] + [f"w{i}" for i in range(60)]
    gap = [" ", " ", " ", "\n", "\t", "\r", "\x0b", "\x0c", "  ", ". "]
    docs = []
    for _ in range(150):
        words = [rng.choice(vocab) for _ in range(rng.randrange(0, 60))]
        words += words[: rng.choice([0, 0, 4, 5, 9, 30])] * rng.choice([1, 2])
        docs.append("".join(x + rng.choice(gap) for x in words))
    good = "This is one good line, with words of its own. "
    docs += [None, "", " \n\n", "a b a b a b a b a b a b", good * 1, "\n".join(f"{good}{i}" for i in range(20)), "x " * 20_000,
             "\n".join(["HOME | ABOUT | NEWS | HELP"] * 3 + [f"Line {i} of the text goes on, and on, to {i * i}." for i in range(30)]),
             "\n".join(f"SHOUTING LINE {i} GOES ON, AND ON" for i in range(9)),
             "Please Click Here now.\n" + "\n".join(f"Line {i} of the text goes on, and on, to {i * i}." for i in range(2)),
             "one two three four five six seven eight nine ten eleven twelve"]
    return docs + ARTICLES


ONE_LINE = " ".join(f"Sentence {i} of the{i} article says that{i} {i * i} is the{i} square of it{i}, more or less." for i in range(200))
HINDI = "\n".join(f"\u092f\u0939 \u092a\u0902\u0915\u094d\u0924\u093f {i} \u0915\u0941\u091b \u0936\u092c\u094d\u0926 \u0915\u0939\u0924\u0940 {i * i} \u0939\u0948{i} \u0914\u0930 \u0930\u0941\u0915\u0924\u0940{i} \u0939\u0948\u0964" for i in range(40))
FURNITURE = ["HOME | ABOUT | NEWS | HELP", "Click here to log in.", "Read more"]
LINES = [f"Line {i} of the{i} text goes on{i}, and on, to {i * i}." for i in range(30)]
ARTICLES = [
    ONE_LINE, ONE_LINE + " Read more about it.", ONE_LINE.replace("Sentence 9 ", "Log in. Sentence 9 "), ONE_LINE.replace("more or less", "with |x|, |y| and |z|", 1),
    ONE_LINE.replace("Sentence 7 of", "JavaScript, which is what the sentence here at hand with its number 7 of"), HINDI, HINDI.replace("\n", " "),
    "\n".join([FURNITURE[0], *LINES[:15], "", FURNITURE[1], *LINES[15:], FURNITURE[2], ""]), "\u3002".join(f"\u53e5\u5b50 {i}" for i in range(100)) + "\u3002",
]


def test_articles_are_kept_and_page_furniture_goes(spark):
    frame = spark.createDataFrame([(i, t, len(t), "s") for i, t in enumerate(ARTICLES)], "doc_id long, text string, n_chars int, clean_text string")
    got = {r.doc_id: r for r in q.keep(frame.repartition(2)).collect()}
    assert set(range(8)) <= set(got) and got[0].clean_text == "s"
    assert all(got[i].text == cleaned(ARTICLES[i]) and got[i].n_chars == len(got[i].text) for i in got)
    # Texts without furniture come back as they were; of the others only the furniture is gone.
    assert all(got[i].text == ARTICLES[i] for i in (0, 3, 4, 5, 6))
    assert got[1].text == ONE_LINE and got[2].text == ONE_LINE.replace("Sentence 9 ", " Sentence 9 ").replace("  Sentence 9", " Sentence 9")
    assert got[7].text == "\n".join([*LINES[:15], "", *LINES[15:], ""])


def test_equals_brute_force(spark):
    docs = [(i, d) for i, d in enumerate(corpus())] + [(None, "a b c"), (3, corpus()[3])]
    frame = spark.createDataFrame([(i, d, "x", 7) for i, d in docs], "doc_id long, text string, words string, n_words int")
    got = sorted(
        ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in q.verdicts(frame.repartition(3)).collect()),
        key=str,
    )
    assert got == sorted(((i, *base(d), kept(d)) for i, d in docs), key=str)


def test_empty_table(spark):
    assert q.verdicts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_native_plan(spark):
    frame = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = q.verdicts(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
