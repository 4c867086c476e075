"""What a page's lists show to be absent, against a walk over the tree of the page."""

from __future__ import annotations

import datetime
import random

from test_pairing import Tree, marks, some_page
from tidemark.operators import enumerations as e


def months_on(day, n):
    y, m = divmod(day.year * 12 + day.month - 1 + n, 12)
    for d in (day.day, 30, 29, 28):
        try:
            return datetime.date(y, m + 1, d)
        except ValueError:
            continue


def judged(markup, field, deadline, ends):
    tree = Tree()
    tree.feed(markup or "")
    tree.close()
    at, dates, labels, lists = 0, [], [], {}
    for u in tree.units.values():
        d, _, n, _ = marks(u["tokens"])
        if u["item"] and (d or n):
            lists.setdefault(u["cont"], []).append((d, {x["field"] for x in n}))
        dates += [(at + x["low"], at + x["high"]) for x in d]
        labels += [(u["cont"] if u["item"] else None, x["field"], at + x["low"], at + x["high"]) for x in n]
        at += len(u["tokens"])
    good = {c: items for c, items in lists.items() if sum(len(d) == 1 for d, _ in items) >= 3 and len({d[0]["day"] for d, _ in items if len(d) == 1} - {None}) >= 2}
    if not good:
        return "no list"
    of = [items for items in good.values() if deadline and any(len(d) == 1 and d[0]["day"] == deadline and "deadline" in f for d, f in items)]
    if not of:
        return "no anchor"
    of = [items for items in of if sum(len(d) == 1 and bool(f) for d, f in items) >= 3]
    if not of:
        return "few milestones"
    days = lambda items: [x for d, _ in items for x in d]
    fits = lambda x: x["day"] and ends and x["day"] >= months_on(deadline, -18) and max(x["day"], x["until"] or x["day"]) <= months_on(ends, 6)
    if not any(all(fits(x) for x in days(items)) for items in of):
        return "out of range"
    if any(field in f for items in good.values() for _, f in items):
        return "listed"
    near = lambda low, high: any(0 <= low - b <= e.NEAR_DATE or 0 <= a - high <= e.NEAR_DATE for a, b in dates)
    return "near a date" if any(c not in good and f == field and near(low, high) for c, f, low, high in labels) else ""


def a_list(rng, day):
    tag, items = rng.choice(["ul", "ol", "dl", "table"]), [("Paper submission", day)]
    items += [(rng.choice(["Notification", "Camera ready", "Poster", "Rebuttal", "Something"]), day + datetime.timedelta(rng.choice([9, 40, 80]))) for _ in range(rng.randint(1, 4))]
    if rng.random() < 0.2:
        items.append(("Abstract", day))
    if rng.random() < 0.15:
        items.append(("Workshop", day + datetime.timedelta(rng.choice([-900, 700]))))
    rng.shuffle(items)
    form = {"dl": "<dt>{}<dd>{}", "table": "<tr><td>{}</td><td>{}</td></tr>"}.get(tag, "<li>{}: {}</li>")
    return f"<{tag}>" + "".join(form.format(n, d.strftime("%B %d, %Y")) for n, d in items) + f"</{tag}>"


def test_absences_of_random_pages(spark):
    rng = random.Random(21)
    pages, claims = [(1, None), (2, ""), (3, "<ul></table>")], [(i, "abstract_deadline", datetime.date(2026, 3, 1), datetime.date(2026, 9, 1)) for i in (1, 2, 3, 4)]
    for i in range(10, 310):
        day = datetime.date(2026, rng.randint(1, 12), rng.randint(1, 28))
        filler = " ".join(["words"] * rng.choice([0, 20, 60]))
        around = [filler, rng.choice(["", "", "", "<p>An abstract is asked for.</p>", some_page(rng)])]
        pages.append((i, "".join([*around, a_list(rng, day), *around[::-1]])))
        known = None if rng.random() < 0.03 else day + datetime.timedelta(rng.random() < 0.1)
        claims.append((i, rng.choice(["abstract_deadline", "abstract_deadline", "date"]), known, None if rng.random() < 0.03 else day + datetime.timedelta(rng.choice([30, 120]))))
    rows = spark.createDataFrame(claims, "page_id long, field string, deadline date, ends date")
    out = {r["page_id"]: r for r in e.structural_absence(rows, spark.createDataFrame(pages, "page_id long, html string")).collect()}
    text = dict(pages)
    want = {i: judged(text.get(i), *rest) for i, *rest in claims}
    assert {i: r["reason"] for i, r in out.items()} == want and all(r["supported"] == (r["reason"] == "") for r in out.values())
    assert set(want.values()) == {"no list", "no anchor", "few milestones", "out of range", "listed", "near a date", ""}
