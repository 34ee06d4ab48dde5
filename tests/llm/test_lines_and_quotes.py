import random
from collections import Counter, defaultdict

import duckdb

from likewise.llm import line_quality as L, line_templates as T, quote_links as Q

from .helpers import awkward, documents, vocabulary


def brute_dropped(docs, min_docs, depth=T.DEPTH):
    """What is left of the texts, by plain loops over dictionaries."""
    mask = lambda line: tuple(T.VARIABLE if any(c in "0123456789" for c in w) else w for w in line.split())
    seen = defaultdict(set)
    for text in docs:
        for line in text.split("\n"):
            if line.split():
                seen[mask(line)].add(text)
    leaves = defaultdict(list)
    for m in seen:
        if len(m) >= depth + T.MIN_CONSTANT:
            leaves[len(m), *m[:depth]].append((m, ()))
    template, nodes = {}, list(leaves.values())
    for _ in range(T.LEVELS):
        deeper = defaultdict(list)
        for k, node in enumerate(nodes):
            counts = Counter((i, m[i]) for m, used in node for i in range(depth, len(m)) if i not in used)
            for m, used in node:
                c, i = max(((counts[i, m[i]], -i) for i in range(depth, len(m)) if i not in used), default=(0, 0))
                if c > 1:
                    deeper[k, -i, m[-i]].append((m, (*used, -i)))
        nodes = []
        for key, node in deeper.items():
            if len(node) < 2 or sum(len(seen[m]) for m, _ in node) < min_docs:
                continue
            constants = []
            for i in range(depth, len(node[0][0])):
                n, w = max((n, w) for w, n in Counter(m[i] for m, _ in node).items())
                if 2 * n >= len(node):
                    constants.append((i, w))
            enough = len(constants) >= T.MIN_CONSTANT and 2 * len(constants) >= len(node[0][0]) - depth
            fits = [m for m, _ in node if enough and 4 * sum(m[i] == w for i, w in constants) >= 3 * len(constants)]
            template.update((m, (_, key)) for m in fits)
            nodes.append([(m, used) for m, used in node if m not in fits])
    of_template = defaultdict(set)
    for m, t in template.items():
        of_template[t] |= seen[m]
    gone = {m for m in seen if len(seen[m]) >= (T.LONG_DOCS if len(m) >= T.LONG_WORDS else min_docs)
            or m in template and len(of_template[template[m]]) >= min_docs}
    return ["\n".join(x for x in text.split("\n") if not x.split() or mask(x) not in gone) for text in docs]


def dropped(spark, texts, **options):
    """The texts without their recurring lines, the counts checked."""
    docs = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    found = {r.row.doc_id: r for r in T.drop_recurring_lines(docs, **options).collect()}
    full = lambda s: sum(bool(x.split()) for x in s.split("\n"))
    for i, t in enumerate(texts):
        assert (found[i].n_lines, found[i].n_dropped) == (full(t), full(t) - full(found[i].text))
    return [found[i].text for i in range(len(texts))]


def test_templates_equal_brute_force(spark):
    rng = random.Random(3)
    vocab = vocabulary(rng, 12)
    shapes = [["GET", "page", "{}", "from", "{}", "took", "{}", "ms"], ["GET", "page", "{}", "to", "{}", "cost", "{}", "cents"],
              ["user", "{}", "logged", "in", "at", "noon"], ["a", "b", "c", "{}", "{}", "{}"],
              ["All", "rights", "reserved."], ["the", "{}", "of", "{}", "in", "{}", "is", "{}", "and", "so", "on"]]
    texts = []
    for i in range(120):
        lines = [" ".join(rng.choice([rng.choice(vocab), str(rng.randint(0, 99)), f"n{rng.randint(0, 9)}"])
                          if w == "{}" else w for w in rng.choice(shapes)) for _ in range(rng.randint(0, 3))]
        lines += [" ".join(vocabulary(rng, rng.randint(1, 9))) for _ in range(3)] + [""]
        if i % 7 == 0:
            lines.append(" ".join(vocab * 5) + f" {i % 3}")
        rng.shuffle(lines)
        texts.append("\n".join([*lines, f"own {'x' * i}"]))
    for min_docs in (4, 12, 40):
        want = brute_dropped(texts, min_docs)
        assert want != texts
        assert dropped(spark, texts, min_docs=min_docs) == want


def test_unique_short_sentences_stay(spark):
    verbs = "sleep leave read write sing run swim eat cook walk rest".split()
    texts = [f"I want to {v}\nYou have to {v} now" for v in verbs]
    assert dropped(spark, texts) == texts


def test_a_long_line_goes_from_the_second_document_on(spark):
    rng = random.Random(11)
    long, short = " ".join(vocabulary(rng, 60)), " ".join(vocabulary(rng, 49))
    texts = [f"{long}\nown {'abcdefghij'[i]}\n{short}" for i in range(9)]
    assert dropped(spark, texts) == [f"own {'abcdefghij'[i]}\n{short}" for i in range(9)]
    assert dropped(spark, texts[:2]) == [f"own {x}\n{short}" for x in "ab"]
    once = [f"{long}\nown a", "other"]
    assert dropped(spark, once) == once


def test_the_smaller_of_two_families_in_a_leaf_is_found(spark):
    rng = random.Random(12)
    names = vocabulary(rng, 80)
    large = [f"the order of {n} was sent by {m} today" for n, m in zip(names[:30], names[30:60])]
    small = [f"the order of {n} came back from {m} damaged" for n, m in zip(names[60:72], names[:12])]
    assert len({len(x.split()) for x in large + small}) == 1
    assert dropped(spark, large + small) == [""] * 42
    assert dropped(spark, large + small[:9]) == [""] * 30 + small[:9]


def test_a_line_of_a_third_of_all_rows(spark):
    texts = [f"the very same line here\nown {'xyz'[i % 3] * (i + 1)}" for i in range(300)]
    assert dropped(spark, texts) == [t.split("\n")[1] for t in texts]


def test_templates_of_awkward_rows(spark):
    docs = awkward(spark)
    found = T.drop_recurring_lines(docs, min_docs=2)
    assert "text" not in found.schema["row"].dataType.names
    texts = Counter((r.row.doc_id, r.text) for r in found.collect())
    # Documents 5 (a repeated row) and null share a line: two documents.
    assert texts[5, ""] == 2 and texts[None, ""] == 1 and texts[1, None] == 1 and sum(texts.values()) == 9
    assert T.drop_recurring_lines(documents(spark, [])).count() == 0


def brute_base(text):
    blanks = " \t\n\x0b\f\r"
    table = str.maketrans({b: " " for b in blanks})
    words = [w for w in (text or "").translate(table).split(" ") if w]
    lines = [x for x in (text or "").split("\n") if x.strip(blanks)]
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i:i + 3])].append(i)
    repeats = {p for at in windows.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(repeats) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(repeats), failed)


def test_base_statistics_equal_brute_force(spark):
    rng = random.Random(4)
    vocab = vocabulary(rng, 9) + ["é#", "\u00a0", "|", "<b>"]
    texts = [None, "", " \n\t"] + ["".join(rng.choice(vocab) + rng.choice([" ", "\n", "\t", "  ", "\x0b", "\n\n"])
                                         for _ in range(rng.choice([3, 40, 60, 300]))) for _ in range(80)]
    texts += ["x " * 20_000, "a b c d " + " ".join(vocabulary(rng, 5000))]
    docs = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    for r in L.judge(docs, columns=["doc_id"]).collect():
        q = r.quality
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == brute_base(
            texts[r.row.doc_id])
        assert not (q.kept and q.base_failed)


def prose(rng, lines=12):
    return [" ".join(vocabulary(rng, 14)).capitalize() + "." for _ in range(lines)]


def test_bad_lines_go_and_poor_documents_too(spark):
    rng = random.Random(5)
    good = prose(rng)
    bad = ["Home | News | Sport | About | Contact", "All rights reserved.", "BUY NOW CHEAP PILLS!!",
           "$$$ %%% ### *** &&&", " ".join(vocabulary(rng, 14)), "very " * 30 + "."]
    docs = documents(spark, [(1, "\n".join(good), None, None), (2, "\n".join(good[:6] + bad[:4] + good[6:] + bad[4:5]), None, None),
                             (3, "\n".join(good[:4] + [x + " " + x for x in bad[:1]] * 60), None, None),
                             (4, "\n".join(prose(rng, 3) + [" | ".join(vocabulary(rng, 90))]), None, None)])
    found = {r.row.doc_id: r.quality for r in L.judge(docs).collect()}
    assert found[1].kept and found[1].lost_chars == 0 and found[1].text == "\n".join(good)
    assert found[2].kept and found[2].text == "\n".join(good)
    assert not found[3].kept and not found[4].kept and not found[4].base_failed
    cleaned = L.clean(docs)
    assert cleaned.columns == docs.columns and {r.doc_id: r.text for r in cleaned.collect()} == {
        1: "\n".join(good), 2: "\n".join(good)}


def test_quality_of_awkward_rows(spark):
    rows = L.judge(awkward(spark)).collect()
    assert len(rows) == 9 and L.judge(documents(spark, [])).count() == 0
    assert all(not r.quality.kept for r in rows)


def messages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows],
                                 "conv_id bigint, turn bigint, role string, text string, h string, conv string, level string")


def test_quotes_are_linked_and_left_out(spark):
    rows = [(1, 0, "user", "Hello there\nhow are you?"), (1, 1, "bot", "I am fine."), (1, 2, "user", "new topic"),
            (1, 3, "user", "On Monday Bot wrote:\n> hello  THERE\n> how are you?\n\nyes, you?"),
            (1, 4, "bot", "> > Hello there\n> yes, you?\nok"), (1, 5, "user", ">I am fine.\ngood"),
            (1, 6, "user", "> never said\nright"), (1, 7, "bot", "> how are you?\nsame"),
            (2, 0, "user", "> I am fine.\nother conversation")]
    got = {(r.conv_id, r.turn): (r.text, r.n_quotes, r.reply_to, r.thread, r.depth, r.position)
           for r in Q.reply_ordered(messages(spark, rows)).collect()}
    assert got == {
        (1, 0): (rows[0][3], 0, None, 0, 0, 1), (1, 3): ("yes, you?", 1, 0, 0, 1, 2), (1, 4): ("ok", 2, 3, 0, 2, 3),
        (1, 7): ("same", 1, 0, 0, 1, 4), (1, 1): ("I am fine.", 0, None, 1, 0, 5), (1, 5): ("good", 1, 1, 1, 1, 6),
        (1, 2): ("new topic", 0, None, 2, 0, 7), (1, 6): ("right", 1, None, 6, 0, 8),
        (2, 0): ("other conversation", 1, None, 0, 0, 1)}
    levels = Q.link_quotes(Q.parse_quotes(messages(spark, rows).selectExpr(
        "conv_id AS conv", "turn", "xxhash64(text) AS h", "text")))
    assert {(r.turn, r.level, r.found) for r in levels.collect()} == {
        (3, 1, 0), (4, 2, 0), (4, 1, 3), (5, 1, 1), (7, 1, 0)}


def test_sql_agrees_on_quotes(spark, tmp_path):
    rng = random.Random(6)
    rows = []
    for conv in range(8):
        texts = []
        for turn in range(rng.randint(1, 12)):
            lines = [rng.choice(["yes", "no way", "Fine by me.", "see  below"]) for _ in range(rng.randint(0, 3))]
            for old in rng.sample(texts, min(len(texts), rng.randint(0, 2))):
                sign = rng.choice(["> ", ">", ">> ", " > > "])
                quote = [sign + x for x in old.split("\n")]
                lines = [*rng.choice([["You wrote:"], [], ["", "Ann said :"]]), *quote, *lines]
            texts.append("\n".join(lines))
            rows.append((conv if conv else None, turn, rng.choice("ub"), texts[-1]))
    messages(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    found = Q.reply_ordered(spark.read.parquet(f"{tmp_path}/conversations.parquet"))
    want = con.sql(Q.reply_ordered_sql()).fetchall()
    assert Counter(map(tuple, found.collect())) == Counter(want)
    assert sum(r[5] is not None for r in want) > 10 and max(r[7] for r in want) > 1


def test_latest_earlier_message_counts_and_chains_resolve(spark):
    rows = [(1, 0, "u", "m0")] + [(1, i, "u", f"> m{i - 1}\nm{i}") for i in range(1, 20)]
    rows += [(2, 0, "u", "ok"), (2, 1, "u", "ok"), (2, 2, "u", "> ok\nsee"), (2, 3, "u", "ok")]
    got = {(r.conv_id, r.turn): r for r in Q.reply_ordered(messages(spark, rows)).collect()}
    assert all(got[1, i].thread == 0 and got[1, i].depth == i and got[1, i].position == i + 1 for i in range(20))
    assert got[2, 2].reply_to == 1 and got[2, 2].thread == 1


def test_long_conversation_is_numbered_through(spark):
    rows = [(1, i, "u", f"text {i}") for i in range(1000)]
    ordered = Q.reply_ordered(messages(spark, rows))
    assert [r.position for r in ordered.orderBy("turn").collect()] == list(range(1, 1001))
    chats = Q.format_chat(ordered).orderBy("part").collect()
    assert len(chats) == 16 and "".join(r.chat for r in chats) == "".join(f"<|u|>\ntext {i}\n" for i in range(1000))


def test_awkward_messages(spark):
    rows = [(None, 1, "u", "a"), (None, None, "u", "> a"), (1, 1, None, None), (1, 1, None, None), (1, 2, "u", ""),
            (1, 1, "u", "long " * 50_000), (1, 3, "u", ">"), (1, 4, "u", "> > >\n>>>")]
    found = Q.reply_ordered(messages(spark, rows))
    got = found.collect()
    assert len(got) == len(rows)
    assert sorted(r.position for r in got if r.conv_id == 1) == [1, 2, 3, 4, 5, 6]
    assert [(r.turn, r.reply_to) for r in got if r.conv_id is None and r.n_quotes] == [(None, None)]
    assert Q.reply_ordered(messages(spark, [])).count() == 0


def test_windows_are_split_by_turns(spark, monkeypatch):
    """One line quoted all over a long conversation; ranges carry the last turn on."""
    monkeypatch.setattr(Q, "TURNS", 16)
    rows = [(1, i, "u", "yes" if i % 5 == 0 else f"> yes\nanswer {i}" if i % 7 == 0 else f"text {i}") for i in range(300)]
    rows += [(None, i, "u", r[3]) for i, r in enumerate(rows[:100])]
    got = {(r.conv_id, r.turn): r for r in Q.reply_ordered(messages(spark, rows)).collect()}
    for conv, turn, _, text in rows:
        want = (turn - 1) // 5 * 5 if text.startswith(">") else None
        assert got[conv, turn].reply_to == want
    for conv in (1, None):
        mine = sorted((r for (c, _), r in got.items() if c == conv), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(1, len(mine) + 1))
        assert [(r.thread, r.turn) for r in mine] == sorted((r.thread, r.turn) for r in mine)


def test_messages_without_a_turn_are_numbered_through(spark):
    rows = [(1, None, "u", "same")] * 200 + [(1, None, "u", "x" * 70 + str(i % 7)) for i in range(50)] + [(1, 3, "u", "z")]
    got = sorted(((r.position, r.turn, r.text) for r in Q.reply_ordered(messages(spark, rows).repartition(6)).collect()))
    assert [p for p, _, _ in got] == list(range(1, 252)) and got[0][1:] == (3, "z")
    assert [t for _, _, t in got[1:]] == sorted(r[3] for r in rows[:-1])


def test_boilerplate_of_four_languages(spark):
    rng = random.Random(15)
    good = prose(rng)
    bad = ["Alle Rechte vorbehalten.", "Datenschutzerklärung und mehr.", "Tous droits réservés.", "Conditions d’utilisation.",
           "Todos los derechos reservados.", "Política de privacidad.", "All rights reserved."]
    docs = documents(spark, [(1, "\n".join([*good, *bad]), None, None)])
    row = L.judge(docs, columns=["doc_id"]).collect()[0].quality
    assert row.text.split("\n") == good and row.kept
