"""Short pieces, unique middles and scripts without blanks; held against the texts alone, without ``units``."""

import random
import re

import pytest

from kpiloom.llm import line_dedup

MENU = "\n".join("Home|About us|Our Team|Contact|Log in|Sign up|Terms of Use|Privacy|Help|Site map|Jobs|Press|Blog".split("|"))
VERSE = "the moon,\nthe sea,\na sail,\nso still,\nno wind,\nno word,\nand then,\na bell,\nfar off,\nrings on,\n"
ITEMS = "apples, pears, plums, figs, dates, limes, kiwis, nuts, oats, rye, barley, millet, spelt, rice, "
TITLES = "Every Good Boy Does Fine And All Cows Eat Grass While Great Big Dogs Fight Animals "
CHINESE = "我们今天讨论数据处理的方法，首先要读取所有文件，然后删除重复的段落。最后把结果写入新的表格！"
THAI = "ประเทศไทยมีอากาศร้อน เมืองหลวงคือกรุงเทพมหานคร ผู้คนชอบกินข้าวกับปลา "
OPEN = "It was on a cold and early morning that all of us left the harbour for good.\n"
CLOSE = "Nobody who saw the old ship leave has ever heard from her crew after that day."


def cut_of(docs):
    return {r["doc_id"]: r for r in line_dedup.repeats(docs).collect()}


def prose(rng, n=3):
    return " ".join(" ".join(f"w{rng.randrange(9**9)}" for _ in range(rng.randint(5, 14))).capitalize() + "." for _ in range(n))


@pytest.mark.parametrize("middle", [
    ", ".join(f"item{i}" for i in range(40)) + ".\n",
    "".join(f"Row {i}\n" for i in range(40)),
    "\U0001f600, \U0001f680, ★, ∑, \n",
    "No. Never.\n",
])
def test_a_unique_middle_of_short_pieces_stays(spark, docs_of, middle):
    got = cut_of(docs_of([OPEN + "Yes. Now.\n" + CLOSE, OPEN + middle + CLOSE]))
    assert got[0]["n_cut"] == 0
    assert middle.strip() in got[1]["text"] and OPEN not in got[1]["text"] and CLOSE not in got[1]["text"]


def test_items_known_one_by_one_are_not_a_passage(spark, docs_of):
    rng = random.Random(3)
    items = ITEMS.split()
    other = items[::2] + items[1::2]
    texts = [prose(rng) + "\n" + ITEMS, OPEN, CLOSE, OPEN + " ".join(other) + "\n" + CLOSE]
    assert " ".join(other) in cut_of(docs_of(texts))[3]["text"]


def test_a_line_of_short_clauses_does_not_vanish(spark, docs_of):
    line = "one, two, buckle, my, shoe, three, four, shut, the, door.\n"
    got = cut_of(docs_of([OPEN + CLOSE, OPEN + line + CLOSE, prose(random.Random(1)) + "\n" + line]))
    assert [line in got[i]["text"] for i in range(3)] == [False, True, False]


@pytest.mark.parametrize("passage", [MENU, VERSE, ITEMS, TITLES, CHINESE, THAI])
def test_a_repeated_passage_of_short_pieces_goes(spark, docs_of, passage):
    rng = random.Random(4)
    texts = [f"{prose(rng)}\n{passage}\n{prose(rng)}" for _ in range(4)]
    got = cut_of(docs_of(texts))
    assert got[0]["text"] == texts[0]
    for i in (1, 2, 3):
        head, tail = texts[i].split(passage)
        left = got[i]["text"]
        assert left.startswith(head.rstrip()) and left.endswith(tail.strip())
        assert len(left) - len(head) - len(tail) < 16  # at most a short last clause stays


def test_passages_inside_lines_without_blanks(spark, docs_of):
    texts = [f"{a}{CHINESE}{b}" for a, b in (("北京欢迎你。", "再见。"), ("上海是一座大城市，", "明天见！"), ("山。", "水。"))]
    got = cut_of(docs_of(texts))
    assert [got[i]["text"].replace(CHINESE, "") for i in range(3)] == [t.replace(CHINESE, "") for t in texts]
    assert [CHINESE in got[i]["text"] for i in range(3)] == [True, False, False]


def test_every_cut_word_stood_earlier_with_its_neighbours(spark, docs_of):
    rng = random.Random(9)
    pieces = [MENU, VERSE, ITEMS, TITLES, OPEN, CLOSE]
    texts = []
    for _ in range(40):
        parts = rng.choices(pieces, k=3) + [", ".join(rng.choices(ITEMS.split(", "), k=rng.randint(1, 9))), prose(rng, 2)]
        rng.shuffle(parts)
        texts.append("\n".join(parts))
    got = cut_of(docs_of(texts))
    seen, n = set(), 0
    for i, text in enumerate(texts):
        words = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"\w+", text)]
        known = set()
        for at in range(len(words) - 3):
            four = tuple(w for *_, w in words[at : at + 4])
            if four in seen:
                known.update(range(at, at + 4))
            seen.add(four)
        for start, stop in (map(int, p.split("-")) for p in got[i]["cut"].split(";") if p):
            inside = [k for k, (a, b, _) in enumerate(words) if start <= a and b <= stop]
            assert set(inside) <= known
            n += len(inside)
    assert n > 1000
