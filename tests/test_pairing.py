"""Pairs of labels and dates against a walk over the tree of the page."""

from __future__ import annotations

import datetime
import random
import re
from html.parser import HTMLParser

from tidemark.operators import pairing
from tidemark.operators.evidence import CYCLES, MONTH_WORDS
from tidemark.operators.pairing import CELLS, CLEARLY, DATE_HEADS, ITEM_OF, JOINTS, LABEL_HEADS, NEAR, PHRASES, SEPARATORS


class Tree(HTMLParser):
    """Units of a page, found with a stack: [list or table, its items] and blocks of flowing text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.units, self.flow, self.struck, self.title, self.in_title, self.silent = [], {}, 0, [], [], False, 0
        self.n, self.titles = 0, {}

    def handle_starttag(self, tag, attrs):
        self.n += 1
        if tag in ("script", "style"):
            self.silent += 1
        if tag in ITEM_OF:
            self.flow += 1
            self.stack.append({"tag": tag, "no": self.n, "item": 0, "cell": 0})
        elif self.stack and tag in ITEM_OF[self.stack[-1]["tag"]]:
            self.stack[-1]["item"] += 1
            self.stack[-1]["cell"] = 0
        if tag in pairing.BLOCKS and tag not in ITEM_OF:
            self.flow += 1
        if self.stack and tag in CELLS:
            self.stack[-1]["cell"] += 1
        if re.fullmatch("h[1-6]", tag):
            self.title, self.in_title = [], True
        if tag in ("s", "del", "strike") or any("line-through" in (v or "") for _, v in attrs):
            self.struck.append(tag)

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.silent -= 1
        if tag in ITEM_OF:
            self.flow += 1
            if self.stack:
                self.stack.pop()
        elif tag in pairing.BLOCKS:
            self.flow += 1
        if re.fullmatch("h[1-6]", tag):
            self.in_title = False
        if tag in self.struck:
            self.struck = [x for x in self.struck if x != tag]

    def handle_data(self, data):
        found = re.findall(pairing.TOKEN, re.sub(r"(\d)(st|nd|rd|th)\b", r"\1", data.casefold()))
        if self.silent or not found:
            return
        if self.in_title:
            self.title += found
        at = self.stack[-1] if self.stack else None
        key = (at["no"], at["item"]) if at else ("flow", self.flow)
        unit = self.units.setdefault(key, {"kind": at and at["tag"], "item": at and at["item"], "cont": at and at["no"], "tokens": [], "title": self.title})
        unit["tokens"] += [(t, at["cell"] if at else 0, bool(self.struck)) for t in found]


def day_of(y, m, d):
    try:
        return datetime.date(int(y), int(m), int(d)) if y else None
    except ValueError:
        return None


def marks(tokens):
    words = [t for t, _, _ in tokens]
    at = lambda i: words[i] if 0 <= i < len(words) else ""
    months = [m[:3] for m in pairing.MONTHS]
    is_day = lambda t: re.fullmatch(r"\d\d?", t) and 1 <= int(t) <= 31
    dates, labels, seps = [], [], []
    for i, t in enumerate(words):
        if re.fullmatch(r"\d{4}-\d{1,2}-\d{1,2}", t):
            dates.append([i, i + 1, tokens[i], *t.split("-")])
        elif t in MONTH_WORDS and is_day(at(i + 1)):
            y = at(i + 2) if re.fullmatch(r"\d{4}", at(i + 2)) else None
            dates.append([i, i + 2 + bool(y), tokens[i], y, months.index(t[:3]) + 1, at(i + 1)])
        elif t in MONTH_WORDS and is_day(at(i - 1)):
            y = at(i + 1) if re.fullmatch(r"\d{4}", at(i + 1)) else None
            dates.append([i - 1, i + 1 + bool(y), tokens[i], y, months.index(t[:3]) + 1, at(i - 1)])
        elif t in SEPARATORS and not tokens[i][2]:
            seps.append(i)
        elif not tokens[i][2]:
            for phrase, field in PHRASES:
                if words[i : i + len(phrase.split())] == phrase.split():
                    if labels and labels[-1][1] >= i and labels[-1][2] == tokens[i][1]:
                        labels[-1][1] = max(labels[-1][1], i + len(phrase.split()))
                    else:
                        labels.append([i, i + len(phrase.split()), tokens[i][1], field, phrase])
                    break
    out = {False: [], True: []}
    joints = set()
    for struck in (False, True):
        same = [d for d in dates if d[2][2] == struck]
        follows = [k > 0 and at(same[k - 1][1]) in JOINTS and same[k - 1][1] + 1 == d[0] for k, d in enumerate(same)] + [False]
        days = [day_of(d[3] or (same[k + 1][3] if follows[k + 1] else None), *d[4:6]) for k, d in enumerate(same)]
        for k, d in enumerate(same):
            if follows[k]:
                joints.add(d[0] - 1)
            else:
                out[struck].append({"low": d[0], "high": d[1], "cell": d[2][1], "day": days[k], "until": days[k + 1] if follows[k + 1] else None})
    return out[False], out[True], [{"low": a, "high": b, "cell": c, "field": f, "label": p} for a, b, c, f, p in labels], [s for s in seps if s not in joints]


def walked(markup):
    tree = Tree()
    tree.feed(markup)
    tree.close()
    units = [u | dict(zip(("dates", "dead", "labels", "seps"), marks(u["tokens"]), strict=True)) for u in tree.units.values()]
    heads = {}
    for u in units:
        if u["kind"] == "table" and u["item"] == 1 and not u["dates"] and not u["dead"]:
            cols = [sorted({c for t, c, _ in u["tokens"] if t in names}) for names in (DATE_HEADS, LABEL_HEADS)]
            if len(cols[0]) == len(cols[1]) == 1 and cols[0] != cols[1]:
                heads[u["cont"]] = (cols[0][0], cols[1][0], u["tokens"])
    text = lambda tokens, cell: " ".join(t for t, c, _ in tokens if c == cell)
    for u in units:
        u["rule"], u["scope"] = None, ""
        if u["cont"] in heads and u["item"] > 1:
            d, n, tokens = heads[u["cont"]]
            u["rule"] = "A"
            u["scope"] = "; ".join(f"{text(tokens, c)}={text(u['tokens'], c)}" for c in sorted({c for _, c, _ in u["tokens"]} - {d, n}))
            for what, col in (("dates", d), ("dead", d), ("labels", n)):
                u[what] = [x for x in u[what] if x["cell"] == col]
        elif u["item"] and u["dates"] and u["labels"]:
            at = next((i for i, (_, c, _) in enumerate(u["tokens"]) if c > 1), -1) if u["kind"] == "dl" else u["seps"][0] if len(u["seps"]) == 1 else -1
            before = [all(x["high"] <= at for x in u[w]) for w in ("dates", "labels")]
            after = [all(x["low"] >= at for x in u[w]) for w in ("dates", "labels")]
            if at >= 0 and (before[0] and after[1] or before[1] and after[0]):
                u["rule"] = "B"
            elif not u["seps"] and u["kind"] != "dl":
                u["rule"] = "C?"
    for cont in {u["cont"] for u in units}:
        loose = [u for u in units if u["cont"] == cont and u["rule"] == "C?"]
        orders = [u["labels"][0]["low"] < u["dates"][0]["low"] for u in loose if len(u["labels"]) == len(u["dates"]) == 1]
        for u in loose:
            u["rule"], u["dissent"] = ("C", len(set(orders)) > 1) if len(orders) >= 2 else (None, False)
    rows = []
    for u in units:
        fields = {x["field"] for x in u["labels"]}
        place = (u["cont"], u["item"], " ".join(u["title"]))
        for d in u["dates"]:
            label, why = (u["labels"] or [{"field": None, "label": None}])[0], None
            if u["rule"]:
                why = "no label" if not u["labels"] else "no order" if u.get("dissent") else "several labels" if len(fields) > 1 else "several dates" if len(u["dates"]) > 1 else None
            else:
                label, why = by_distance(d, u["dates"], u["labels"])
            if not why and d["until"] and label["field"] in CYCLES:
                why = "range"
            rows.append((*place, u["rule"] or "D", label["field"], label["label"], u["scope"], d["day"], d["until"], "refused" if why else "paired", why or "", d["low"]))
        for d in u["dead"]:
            one = u["labels"][0] if len(fields) == 1 else {"field": None, "label": None}
            rows.append((*place, "", one["field"], one["label"], u["scope"], d["day"], d["until"], "superseded", "", d["low"]))
    return rows


def gaps(d, labels):
    both = [(d["low"] - x["high"], False, x) for x in labels if x["high"] <= d["low"]] + [(x["low"] - d["high"], True, x) for x in labels if x["low"] >= d["high"]]
    return sorted(both, key=lambda g: (g[0], g[1], g[2]["low"]))


def by_distance(d, dates, labels):
    near = gaps(d, labels)
    if not near:
        return {"field": None, "label": None}, "no label"
    gap, side, best = near[0]
    other = [g for g in near if g[1] != side]
    low, high = min(d["high"], best["high"]), max(d["low"], best["low"])
    if gap > NEAR:
        return best, "too far"
    if other and other[0][0] - gap < CLEARLY:
        return best, "two sides"
    if any(x["low"] >= low and x["high"] <= high for x in dates):
        return best, "a date between"
    if any(x is not d and (g := gaps(x, labels)) and g[0][2] is best for x in dates):
        return best, "two dates"
    return best, None


def some_date(rng):
    y, m, d = rng.randint(2024, 2027), rng.randint(1, 12), rng.randint(1, 28)
    name = pairing.MONTHS[m - 1]
    one = rng.choice([f"{name.title()} {d}, {y}", f"{d} {name[:3].title()} {y}", f"{y}-{m:02d}-{d:02d}", f"{name[:3].upper()} {d}th", f"{d} {name}", f"{name} 31 {y}"])
    return one if rng.random() < 0.85 else f"{name} {d} {rng.choice(['to', '-', '–'])} {rng.choice(['', name + ' '])}{d}, {y}"


def some_text(rng):
    label = rng.choice([*[p for p, _ in PHRASES], "Paper submission deadline", "Abstract registration"])
    when, filler = some_date(rng), " ".join(rng.choice("we ask all authors to send their work on time please".split()) for _ in range(rng.choice([0, 0, 1, 3, 9])))
    if rng.random() < 0.15:
        when = rng.choice(["<s>{}</s>", "<del>{}</del>", '<span style="text-decoration:line-through">{}</span>']).format(when) + rng.choice(["", " " + some_date(rng)])
    parts = [label, filler, when] if rng.random() < 0.6 else [when, filler, label]
    if rng.random() < 0.2:
        parts.append(rng.choice([label, when, some_date(rng), "notification"]))
    return rng.choice([": ", " ", " ", " – "]).join(p for p in parts if p) if rng.random() < 0.9 else f"<b>{label}</b>"


def some_page(rng):
    out = ["<html><body><!-- <li>May 1, 2026 --><script>var a = '<p>June 1, 2026';</script>"]
    end = lambda tag: f"</{tag}>" if rng.random() < 0.7 else ""
    for _ in range(rng.randint(1, 5)):
        kind = rng.choice(["ul", "ol", "dl", "table", "p", "p", "h2", "nested"])
        if kind in ("ul", "ol"):
            out.append(f"<{kind}>" + "".join(f"<li>{some_text(rng)}{end('li')}" for _ in range(rng.randint(1, 4))) + f"</{kind}>")
        elif kind == "nested":
            out.append(f"<ul><li>{some_text(rng)}<ul><li>{some_text(rng)}<li>{some_text(rng)}</ul> and {some_text(rng)}{end('li')}<li>{some_text(rng)}</ul>")
        elif kind == "dl":
            out.append("<dl>" + "".join(f"<dt>{rng.choice(PHRASES)[0]}{end('dt')}<dd>{some_date(rng)}{end('dd')}" for _ in range(rng.randint(1, 3))) + "</dl>")
        elif kind == "table":
            columns = [*rng.sample(["Event", "Date", "Track", "Milestone"], 3)]
            rows = [[{"Event": rng.choice(PHRASES)[0], "Milestone": rng.choice(PHRASES)[0], "Date": some_date(rng), "Track": "main"}[c] for c in columns] for _ in range(rng.randint(1, 3))]
            head = [[f"<th>{c}{end('th')}" for c in columns]] if rng.random() < 0.7 else []
            out.append("<table>" + "".join("<tr>" + "".join(r) + end("tr") for r in [*head, *[[f"<td>{c}{end('td')}" for c in r] for r in rows]]) + "</table>")
        else:
            out.append(f"<{kind}>{some_text(rng)} {some_text(rng) if rng.random() < 0.3 else ''}</{kind}>")
    return "".join(out) + "</body></html>"


def test_pairs_of_random_pages(spark):
    rng = random.Random(8)
    pages = [(i, some_page(rng)) for i in range(250)] + [(900, None), (901, ""), (902, "plain text, paper submission: May 3, 2026"), (903, "</ul></table><li>Abstract: May 3, 2026"), (904, "<ul><li>Papers due: May 3, 2026 May 5, 2026</ul>")]
    got = {}
    for r in pairing.paired(spark.createDataFrame(pages, "page_id long, html string")).collect():
        got.setdefault(r["page_id"], []).append((r["cont"] is not None, r["item"], *[r[c] for c in ("heading", "rule", "field", "label", "scope", "day", "until", "outcome", "reason", "low")]))
    seen = set()
    for i, page in pages:
        want = [(c is not None, *rest) for c, *rest in walked(page or "")]
        assert sorted(got.get(i, []), key=repr) == sorted(want, key=repr), page
        seen |= {(r[3], r[9], r[10]) for r in want}
    # Each rule pairs and refuses somewhere.
    assert {("A", "paired", ""), ("B", "paired", ""), ("C", "paired", ""), ("D", "paired", ""), ("A", "refused", "range"), ("B", "refused", "several dates"), ("C", "refused", "no order"), ("D", "refused", "two sides"), ("D", "refused", "too far"), ("", "superseded", "")} <= seen, seen


def test_years_and_claims(spark):
    page = "<table><tr><th>Date<th>Event<th>Track<tr><td>Feb 10<td>Paper submission<td>main</table><ul><li>Abstract: <s>Feb 1</s> Feb 8</ul><p>Paper submission is on March 1."
    pairs = pairing.paired(spark.createDataFrame([(1, page, 2026)], "page_id long, html string, year int"), year="year")
    day = lambda m, d: datetime.date(2026, m, d)
    assert {(r["field"], r["day"], r["outcome"]) for r in pairs.collect()} == {("deadline", day(2, 10), "paired"), ("abstract_deadline", day(2, 8), "paired"), ("abstract_deadline", day(2, 1), "superseded"), ("deadline", day(3, 1), "paired")}
    claims = [(1, "deadline", day(2, 10), None), (1, "deadline", day(2, 10), "track=main"), (1, "abstract_deadline", day(2, 1), None), (1, "abstract_deadline", day(2, 8), None), (1, "deadline", day(3, 1), None), (2, "deadline", day(3, 1), None)]
    out = pairing.proposal_pairing(spark.createDataFrame(claims, "page_id long, field string, day date, scope string"), pairs).collect()
    assert {tuple(r)[:4]: r["status"] for r in out} == dict(zip(claims, ("UNCONFIRMED", "VERIFIED", "REFUTED", "VERIFIED", "VERIFIED", "UNCONFIRMED"), strict=True))


def test_months_within_codes(spark):
    """A month's name inside a hash or a key is no date; dates that are written in one word are."""
    said = {1: "key e9feb9cda", 2: "ce5feb9337387b", 3: "1dec12345678", 4: "id 2026-01-012345", 5: "papers due 5march2026", 6: "papers due 5 march2026", 7: "papers due march5 2026", 8: "papers due 5thmarch"}
    rows = spark.createDataFrame([(k, f"<p>{x}</p>") for k, x in said.items()], "page_id long, html string")
    day = datetime.date(2026, 3, 5)
    assert {(r["page_id"], r["day"]) for r in pairing.paired(rows).collect()} == {(5, day), (6, day), (7, day)}


def test_parts_grow_with_the_pages(spark, monkeypatch):
    """A task holds so many pages however many there are, for pairs and for lists."""
    from tidemark.operators import enumerations

    monkeypatch.setattr(pairing, "PAGES", 5)
    rows = spark.createDataFrame([(k, "<ul><li>Paper due: March 5, 2026</li></ul>") for k in range(100)], "page_id long, html string")
    for df in (pairing.pieces(rows, "page_id", "html"), enumerations.placed_marks(rows, "page_id", "html")):
        assert "REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString()
    assert pairing.pieces(rows, "page_id", "html").rdd.getNumPartitions() == 20
    assert pairing.paired(rows).count() == 100
