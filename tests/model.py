"""A plain one-item-at-a-time model of a run, to hold the set-based plan against.

It takes values as typed already, so that it says nothing about reading display text.
"""

import datetime as dt


def votes(text, zero):
    if text in zero:
        return 0
    try:
        if text.endswith("k"):
            return round(float(text[:-1]) * 1000)
        return int(text)
    except (AttributeError, ValueError):
        return "bad"


def moment(text, at):
    if text is None:
        return None
    parts = text.split()
    if not parts:
        return "bad"
    if parts[0] == "just":
        return at
    if len(parts) < 2:
        return "bad"
    if parts[1] not in ("hours", "days"):
        return at
    try:
        return at - dt.timedelta(**{parts[1]: int(parts[0])})
    except ValueError:
        return "bad"


class Model:
    def __init__(self, key=("text",)):
        self.key = key
        self.posts, self.comments, self.communities = {}, {}, set()
        self.post_marks, self.comment_marks, self.rejects = {}, {}, []

    def run(self, items, started):
        post_low, comment_low, seen = {}, {}, set()
        for it in sorted(items, key=lambda i: (i["captured_at"], i["seq"])):
            name, order = it["community"], (it["captured_at"], it["seq"])
            if name is None:
                self.rejects.append(("post", "community", it["seq"], None))
                continue
            seen.add(name)
            self.communities.add(name)
            when = moment(it["postTimeSince"], it["captured_at"])
            up = votes(it["postUpVotes"], ("•", "Vote", "None"))
            percent = 0 if not it["postPercentUpVotes"] else int(it["postPercentUpVotes"][:-1])
            wrong = [
                reason
                for reason, bad in [
                    ("age", when == "bad"),
                    ("votes", up == "bad"),
                    ("title", it["postTitle"] is None),
                ]
                if bad
            ]
            if wrong:
                self.rejects.append(("post", wrong[0], it["seq"], None))
                continue
            title = it["postTitle"]
            counters = dict(
                upvotes=up,
                percent_upvotes=percent,
                comment_count=len(it["comments"]),
                community=name,
                last=order,
            )
            if title in self.posts:
                if order >= self.posts[title]["last"]:
                    self.posts[title].update(counters)
            elif it["postUserName"] is None or when is None:
                reason = "author" if it["postUserName"] is None else "datetime"
                self.rejects.append(("post", reason, it["seq"], None))
                continue
            else:
                text = " ".join(p for p in it["postText"] if p is not None)
                self.posts[title] = dict(
                    author=it["postUserName"], text=text, datetime=when, **counters
                )
            post_low[name] = min(post_low.get(name, started), self.posts[title]["datetime"])
            for pos, c in enumerate(it["comments"]):
                up = 0 if c["commentUpVotes"] is None else votes(c["commentUpVotes"], ("Vote",))
                when = moment(c["commentTimeSince"], it["captured_at"])
                text = " ".join(p for p in c["commentText"] if p is not None)
                reason = (
                    "votes"
                    if up == "bad"
                    else "age"
                    if when == "bad"
                    else "incomplete"
                    if when is None or c["commentUserName"] is None
                    else None
                )
                if reason:
                    self.rejects.append(("comment", reason, it["seq"], pos))
                    continue
                comment_low[name] = min(comment_low.get(name, started), when)
                row = dict(
                    text=text,
                    author=c["commentUserName"],
                    upvotes=up,
                    datetime=when,
                    title=title,
                    community=name,
                    last=(*order, pos),
                )
                key = tuple(row[{"post_id": "title"}.get(k, k)] for k in self.key)
                if key not in self.comments or row["last"] >= self.comments[key]["last"]:
                    self.comments[key] = row
        for name in seen:
            self.post_marks[name] = min(started, post_low.get(name, started))
            self.comment_marks[name] = min(started, comment_low.get(name, started))
