import random

import pytest

from newsloom.llm import boilerplate, residue, truncation

NAMES = [f"{a}{b}" for a in ("Bor", "Kel", "Mur", "Tas", "Vin", "Zol") for b in ("dak", "fen", "gor", "lim", "nup", "rex")]
VERBS = ["opened", "closed", "bought", "sold", "audited", "delayed", "renamed", "tested"]
NOUNS = ["harbor", "ferry", "bridge", "market", "school", "tunnel", "library", "reservoir"]


def sentence(r):
    return f"The {r.choice(NOUNS)} council of {r.choice(NAMES)} {r.choice(VERBS)} {r.randint(2, 9999)} boats near the old {r.choice(NOUNS)} in {r.choice(NAMES)}."


def headline(r):
    return f"{r.choice(NAMES)} {r.choice(NOUNS)} {r.choice(VERBS)} second {r.choice(NOUNS)} near {r.choice(NAMES)}"


def page(r, host):
    """(lines, numbers of the lines around the article)"""
    lines, around = [], []

    def put(x, outside):
        lines.append(x)
        if outside and x.strip():
            around.append(len(lines))

    if r.random() < 0.6:
        for x in ("Home", "World", "Sports", "Log in"):
            put(x, True)
    put("", False)
    if r.random() < 0.4:
        put("This site uses cookies to measure audiences.", True)
        put("Accept all", True)
    for k in range(r.randint(2, 5)):
        put(sentence(r), False)
        if k == 1 and r.random() < 0.7:
            put("Background", False)
            put(sentence(r), False)
            put(f"- {headline(r)}", False)
        if k == 0 and r.random() < 0.3:
            put("Advertisement", True)
    if r.random() < 0.6:
        put("Most read", True)
        for _ in range(3):
            put(headline(r), True)
    put(f"© 2025 {host}. All rights reserved.", True)
    return lines, around


def _pages(n=240):
    r = random.Random(3)
    out = []
    for i in range(n):
        host = f"host{i % 4}"
        lines, around = page(r, host)
        out.append((i, host, f"Title {i} {headline(r)}", "\n".join(lines), "body_extracted", set(around)))
    for k in range(12):  # copies of one story do not make its lines furniture
        out.append((1000 + k, "host0", out[1][2], out[1][3], "", out[1][5]))
    return out


SCHEMA = "ingest_seq bigint, source_id string, title string, body_text string, fulltext_note string, lines string, keys int"


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_furniture(spark, limit):
    pages = _pages()
    rows = [(*p[:5], "clash", 1) for p in pages] + [(5000, "host0", "t", None, None, "", 0), (5001, None, None, "", "", "", 0), (5002, None, None, "word " * 40000, "", "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in boilerplate.furniture_lines(df, tree=boilerplate.StyleTree(blocks_over=limit)).collect():
        got.setdefault(r["ingest_seq"], set()).add(r["line_no"])
    wrong = [(p[0], got.get(p[0], set()) ^ p[5]) for p in pages if got.get(p[0], set()) != p[5]]
    assert not wrong, wrong[:3]
    assert not {5000, 5001, 5002} & set(got)
    text = {r["ingest_seq"]: r["main_text"] for r in boilerplate.main_text(df).collect()}
    assert "Background" in " ".join(text.values()) and "All rights" not in " ".join(text.values()) and len(text[5002]) > 190_000
    assert boilerplate.furniture_lines(df.limit(0)).count() == 0


def test_copies_of_one_story_keep_furniture_low(spark):
    r = random.Random(12)
    bodies = ["\n".join(["Harbor desk notes", *(sentence(r) for _ in range(5))]) for _ in range(30)]
    bodies += [bodies[0]] * 600
    df = spark.createDataFrame([(i, "host0", b) for i, b in enumerate(bodies)], "ingest_seq bigint, source_id string, body_text string")
    got = {(x["ingest_seq"], x["line_no"]) for x in boilerplate.furniture_lines(df).collect()}
    assert got == {(i, 1) for i in range(len(bodies))}


def test_residue(spark):
    pages = [p for p in _pages() if p[0] < 1000]
    r = random.Random(8)
    bad = {
        2000: "{{ story.headline }}",
        2001: sentence(r) + "\n" + sentence(r) + " [INSERT STORY TEXT HERE] " + sentence(r),
        2002: "Lorem ipsum vorem nimbus porta orci vorem nimbus porta",
        2003: "undefined undefined undefined",
        2004: "404 Not Found",
        2005: "Please enable JavaScript to view this page.",
        2006: '{"status":503,"error":"Bad Gateway","ref":"a1b2c3"}',
        2007: "<html><body><h1>Service Unavailable</h1><hr>edge-4b8</body></html>",
        2008: "此处填写正文内容",
        2009: "__ITEM_BODY__",
        2010: sentence(r) + "\nPorta orci vorem nimbus vorem porta nimbus orci",
        2011: "Lorem ipsum nimbus orci porta vorem",
    }
    good = {
        3000: 'A bug printed the raw tag "{{ user }}" on 12 invoices. ' + sentence(r),
        3001: "Visitors saw a 404 page for 20 minutes after the move, said the council of Bordak. " + sentence(r),
        3002: "The port authority will drop JavaScript from its portal so that old phones can open it. " + sentence(r) * 3,
        3003: "Designers still paste lorem ipsum into mock-ups, the mayor of Kelfen joked. " + sentence(r) * 3,
        3004: None,
        3005: "",
    }
    rows = [(*p[:5], "c", 1) for p in pages]
    rows += [(i, "host1", f"T{i} {headline(r)}", t, "", "c", 1) for i, t in {**bad, **good}.items()]
    # the whole page of one server stands under unlike titles
    rows += [(4000 + i, "host2", f"{headline(r)} {i}", "The reading room is closed for this edition\nTicket 8812f", "", "c", 1) for i in range(6)]
    rows += [(4100 + i, "host2", "One and the same title", sentence(random.Random(1)), "", "c", 1) for i in range(6)]
    notes = {6000: ("note: {{ page.date }}; attempt 2", True), 6001: ("<h1>Not Found</h1> ref ab12", True), 6002: ("http_404", False), 6003: ("second fetch used; first answer was http_503", False), 6004: ("undefined", True), 6005: (None, False), 6006: ("template_v2 reader; script tags removed", False), 6007: ("Oops! Bad Gateway", True)}
    rows += [(i, "host3", "t", None, n, "c", 1) for i, (n, _) in notes.items()]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(x["ingest_seq"], x["field_name"]) for x in residue.residue(df).collect()}
    body = {i for i, f in got if f == "body_text"}
    assert body == set(bad) | {4000 + i for i in range(6)}, (set(bad) - body, body - set(bad))
    assert {i for i, f in got if f == "fulltext_note"} == {i for i, (_, b) in notes.items() if b}
    assert residue.residue(df.limit(0)).count() == 0


def test_residue_on_many_pages_is_no_furniture(spark):
    r = random.Random(21)
    rows = []
    for i in range(40):
        slot = {0: "{{{title}}}", 1: "undefined"}.get(i % 4)
        lines = [*([slot] if slot else []), *(sentence(r) for _ in range(6))]
        rows.append((i, f"host{i % 2}", headline(r), "\n".join(lines), ""))
    df = spark.createDataFrame(rows, "ingest_seq bigint, source_id string, title string, body_text string, fulltext_note string")
    assert {x["ingest_seq"] for x in residue.residue(df).collect()} == {i for i in range(40) if i % 4 < 2}


def test_templates_left_on_many_records(spark):
    r = random.Random(22)
    long = "\n".join(f"Step {k} of the inspection could not be finished because the gateway closed the line before your reader answered it in time." for k in "abcde")
    same = "\n".join(sentence(r) for _ in range(8))  # one article under several headlines made of its words
    own = lambda: " ".join(r.sample([w for w in same.replace(".", "").split() if w.isalpha()], 8))
    rows = [(i, "Dear {{name}}, welcome") for i in range(5)]
    rows += [(100 + i, f"Dear reader {{{{name}}}}, your copy of the harbor news is ready.\n{sentence(r)}") for i in range(5)]
    rows += [(200 + i, long) for i in range(6)]
    rows += [(300 + i, f"{sentence(r)[:-1]} and the page printed {{{{ user }}}} on every invoice of {r.choice(NAMES)} before noon.") for i in range(6)]
    rows = [(i, f"host{i % 3}", f"{headline(r)} {i}", b, "") for i, b in rows] + [(400 + i, "host1", own(), same, "") for i in range(6)]
    assert len(long) > 400
    df = spark.createDataFrame(rows, "ingest_seq bigint, source_id string, title string, body_text string, fulltext_note string")
    assert {x["ingest_seq"] for x in residue.residue(df).collect()} == {x[0] for x in rows if x[0] < 300}


def test_ends():
    f = lambda t: truncation.form(truncation.strip_counters(t))[0]
    for t in ("The ferry opened...", "The ferry op…", "The ferry [...]", "The ferry was (more)", "The ferry was... Read more", "渡轮 阅读全文"):
        assert f(t) == "marked", t
    for t in ("The ferry &am", "The ferry &#82", "渡轮�", "The ferry,", "The ferry opened and,"):
        assert f(t) == "broken", t
    for t in ("The ferry opened.", 'She said: "Not yet..."', "It opened. | votes=3; replies=4", "渡轮开放。", "Boats (Bordak)", "Boats sail - Daily Paper", ""):
        assert f(t) == "closed", t
    for t in ("The ferry opened in spri | votes=3; replies=4", "Output fell 53.", "渡轮航"):
        assert f(t) == "open", t


def test_alignment():
    full = "The harbor council of Bordak opened nine boats near the old reservoir in Kelfen"
    assert truncation.ends_early("The harbor council of Bordak opened nine bo", full) == "word"
    assert truncation.ends_early("The harbor council of Bordak opened nine", full) == "text"
    assert truncation.ends_early(full, full + " - Daily Paper") == "same"
    assert truncation.ends_early("Quite another title of some length here", full) == ""
    assert truncation.ends_early("short", full) == ""


def test_cut_values(spark):
    r = random.Random(5)
    rows, want = [], set()
    for i in range(600):
        title, summary = headline(r), f"{sentence(r)} {sentence(r)}"
        rows.append([i, f"s{i % 5}", title, summary])
        if i % 20 == 3:
            cut = summary.rindex("council") + 3
            rows[-1][3] = summary[:cut]
            want.add((i, "summary"))
        if i % 20 == 7:
            rows[-1][2] = title[: title.index("second") + 2 + i // 20 % 4]
            want.add((i, "title"))
        if i % 20 == 11:
            rows[-1][2] = title[:-6] + "..."
            want.add((i, "title"))
        if i % 20 == 13:
            rows[-1][3] = title  # a headline in place of a summary is whole
    name = "The long parade of Quorvanthil"
    rows += [[900, "s0", f"{headline(r)} and {name}", None], [901, None, None, ""], [902, "s0", None, "word " * 30000 + "end."], [903, "s0", rows[3][2], rows[3][3]]]
    want.add((903, "summary"))
    df = spark.createDataFrame([(*x, "c", 2) for x in rows], "ingest_seq bigint, source_id string, title string, summary string, v string, word int")
    cuts = truncation.cut_values(df, "ingest_seq", ["title", "summary"])
    got = {(x["ingest_seq"], x["field_name"]) for x in cuts.collect()}
    assert got == want, (want - got, got - want)
    rates = {(x["source_id"], x["field_name"]): x for x in truncation.cut_rates(df, cuts, "ingest_seq", "source_id", ["title", "summary"]).collect()}
    assert sum(x["n_cut"] for x in rates.values()) == len(want) and all(0 <= x["share"] <= 1 for x in rates.values())
    assert truncation.cut_values(df.limit(0), "ingest_seq", ["title", "summary"]).count() == 0


def test_copy_that_goes_on(spark):
    r = random.Random(6)
    rows = [(i, headline(r)) for i in range(300)]
    full = "The harbor council of Bordak opened nine new boats near Quorvanthil yesterday"
    rows += [(900, full), (901, full[: full.index("Quorvan") + 4])]
    df = spark.createDataFrame(rows, "ingest_seq bigint, title string")
    got = {x["ingest_seq"]: x["why"] for x in truncation.cut_values(df, "ingest_seq", ["title"]).collect()}
    assert got == {901: "copy goes on inside the word"}


def test_alignment_alone_finds_cut_copies(spark):
    """Long lists (joined by last words) and short ones (paired) flag the same copies."""
    import random

    random.seed(3)
    words = ["".join(random.choice("abcdefghiklmnoprstuvw") for _ in range(random.randint(4, 9))) for _ in range(300)]
    rows, cut = [], set()
    head = [random.choice(words) for _ in range(30)]
    for i in range(120):
        body = head[:26] + [random.choice(words) for _ in range(14)]
        rows.append((2 * i, " ".join(body) + "."))
        if i % 3 == 0:
            rows.append((2 * i + 1, " ".join(body[:33]) + " " + body[33][:-2]))
            cut.add(2 * i + 1)
    df = spark.createDataFrame(rows, "v bigint, text string")
    read = df.mapInArrow(truncation._read(truncation.Closing()), truncation._READ).filter("v is not null")
    for limit in (8, 64, 4096):
        got = {x["v"] for x in truncation._alignments(read, truncation.Closing(long_list=limit)).filter("how = 'word'").collect()}
        assert got == cut, limit


def test_near_copies_are_verified():
    c = truncation.Closing()
    full = "the harbor council of the old town opened nine bridges on monday after two years of work"
    assert truncation.near_copy("the harbor council of the old town opened nine bridges on mon", full, c)
    assert not truncation.near_copy("a wholly other start before the old town opened nine bridges on mon", full, c)
    assert truncation.bare("One two three... Read more") == "One two three"


def test_messages_of_any_length_are_read(spark):
    """A notice of one long sentence, a long error page and a long filler line count like short ones; an article about them does not."""
    notice = "To read this page please enable JavaScript in the settings of the program you use to look at pages, since nothing here can be shown without it"
    assert len(notice) > 120
    error = " ".join(f"The requested page could not be found on the server number {i} of our cluster, please go back to the start and try it again later." for i in range(8))
    article = "The ministry said that many readers saw the words access denied on Monday. " + "It gave no reason for the outage of the port register, and the harbor council met again. " * 8
    vocabulary = frozenset(["dolor", "sit", "amet", "elit"])
    long_filler = "dolor sit amet elit " * 40 + "harbor"
    assert residue.told(notice) == ("notice", len(notice)) and residue.says(error) == "error"
    assert residue.told(article)[1] < 0.2 * len(article)
    assert residue._made_of(long_filler, vocabulary) and not residue._made_of("dolor " + article, vocabulary)
    assert residue.repeated("sample words, " * 500) and not residue.repeated(article) and not residue.repeated("=======")
    for x in ("This sample text goes here", "Page not found", "JavaScript is disabled", "Seite nicht gefunden.", "运行 启用JavaScript"):
        assert residue._worded(x) and residue.says(x), x
    rows = [(1, "s", f"Title one {notice[:9]}", notice), (2, "s", "Second", error), (3, "s", "Port register", article), (4, "s", "Fourth", article + "\n" + article.replace("Monday", "Friday") + "\nplease enable JavaScript")]
    df = spark.createDataFrame([(*r, None) for r in rows], "ingest_seq bigint, source_id string, title string, body_text string, fulltext_note string")
    assert {x["ingest_seq"] for x in residue.residue(df).collect()} == {1, 2}


def test_literals_stand_in_what_their_patterns_match():
    import re

    for block in (residue.ERRORS, residue.NOTICES, residue.FILLERS):
        for word in residue._LITERALS:
            assert word == word.lower() and word.strip()
    assert all(any(w in x for w in residue._LITERALS) for x in ("vérifiez votre navigateur", "error code: 5", "gateway timeout page", "verify that you're human", "sample paragraph"))
    assert re.search(residue._NOTICE, "verify you are human")


def test_nodes_joined_or_held_part_pages_alike(spark):
    """The table of low nodes may be joined line by line instead of held by the workers."""
    pages = [(10 * h + i, f"host{h}", f"Home\nNews {i}\n\n" + f"Story {i} of host {h} tells at length how council {i * 7 + h} met and decided on bridge {i}. " * 5 + "\n\nContact us\nTerms of use") for h in range(3) for i in range(9)]
    df = spark.createDataFrame(pages, "ingest_seq bigint, source_id string, body_text string")
    rows = lambda **k: sorted(map(tuple, boilerplate.furniture_lines(df, tree=boilerplate.StyleTree(**k)).collect()))
    assert rows() == rows(blocks_over=0) and len(rows()) > 0


def test_long_consent_lines():
    short = "We use cookies to measure visits."
    assert boilerplate._is_consent(short) and boilerplate._is_consent(" ".join([short, "You may withdraw consent at any time in the settings of this page."] * 6))
    assert not boilerplate._is_consent("The council said that cookies were handed out. " + "It then met for hours and decided on the bridge over the river. " * 4)


def test_verdicts_do_not_depend_on_the_length_of_lists(spark):
    """Lists paired whole and lists paired by last words give the same verdicts; unverified last words alone give none."""
    rng = random.Random(23)
    words = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]
    texts = []
    for story in range(12):
        base = [rng.choice(words) for _ in range(40)]
        for _ in range(9):
            own = [rng.choice(words) if i > 5 and rng.random() < 0.3 else w for i, w in enumerate(base)]
            cut = rng.randint(8, 39)
            texts.append(" ".join(own) + "." if rng.random() < 0.5 else " ".join([*base[:cut], base[cut][: rng.randint(1, 3)]]))
    texts += [t[:-1] + ", ..." for t in texts[:10]]
    seen = []
    for limit in (1, 3, 10**6):
        c = truncation.Closing(long_list=limit, similarity=0.8)
        read = spark.createDataFrame(list(enumerate(dict.fromkeys(texts))), "v bigint, text string").mapInArrow(truncation._read(c), truncation._READ).filter("v is not null")
        seen.append({tuple(r) for r in truncation._alignments(read, c).collect()})
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) > 20
