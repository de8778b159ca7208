"""Made-up page layouts with a label for every block, to train the block labeller."""

from __future__ import annotations

import random

#: Marks that stand before content and other text in a training page.
CONTENT, OTHER = "\x01", "\x02"

# Names that sites give to parts that are not the article, by kind: elements, names, phrases.
KINDS = {
    "menu": ("nav div ul div", "nav menu navbar navigation topnav breadcrumb breadcrumbs tabs pagination toc links skip sitemap", "Home|Menu|About|Contact|Next|Previous|News|Sports|Back to top"),
    "header": ("header div div", "header masthead top branding logo site topbar banner hero title", "Welcome|Log in|Sign in|Search|Language"),
    "footer": ("footer div div", "footer bottom copyright legal colophon site info credits imprint contentinfo", "Copyright|All rights reserved|©|Terms of use|Privacy policy|Imprint|Contact"),
    "sidebar": ("aside div section", "sidebar aside widget related recommended popular trending tags archive rail more also secondary complementary teaser promo latest", "Related|Most read|Popular|Recent posts|Tags|Archive|You may also like"),
    "ad": ("div div section ins", "ad ads advert advertisement advertising sponsor sponsored promo adsense banner dfp commercial promotion", "Advertisement|Sponsored|Buy now|Special offer|Ad"),
    "notice": ("div section div", "notice cookie cookies consent gdpr alert privacy popup modal overlay warning banner dialog paywall message announcement toast", "We use cookies|Accept all|This site uses cookies|Please enable|Notice|Subscribe to continue"),
    "form": ("form form fieldset", "form search login subscribe newsletter signup contact register feedback poll", "Email|Submit|Name|Password|Sign up|Search|Send"),
    "comments": ("section div ol ul", "comments comment commentlist reply replies discussion responses disqus respond thread reviews reader user", "Comments|Reply|says:|Leave a comment|Report|Likes"),
    "share": ("div ul", "share social follow tools print sharing buttons", "Share|Tweet|Follow us|Print|Email this"),
}
BODY = "article content post entry story body text main single page articlebody detail copy"
PLAIN = "wrap wrapper container row col inner outer layout grid box block area section page site app root group item left right"

_SYLLABLES = "an ar be ca chi da de el en er est fi ga ho in is ka la le lo ma me mi na ne no on or pa po ra re ri sa se si so ta te ti to un ur va ve vi za é ü ñ ß è ç ô the ing tion ed ment heit ción eau".split()


class Layout:
    """One random page."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.style = self.r.choice(["", "", "", "junk", "upper", "pipes"])

    def word(self) -> str:
        w = "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.choice([1, 1, 2, 2, 3, 4])))
        return w

    def sentence(self, n: int) -> str:
        words = [self.word() for _ in range(max(1, n))]
        words[0] = words[0].capitalize()
        text = " ".join(w + ("," if self.r.random() < 0.08 else "") for w in words) + self.r.choice([".", ".", "", "!", "?"])
        if self.style == "junk":
            text = " ".join(w + self.r.choice(["***", "&amp;&amp;", "###", "%%%"]) for w in text.split())
        elif self.style == "upper":
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif self.style == "pipes":
            text = text.replace(" ", " | ")
        return text

    def prose(self) -> str:
        return " ".join(self.sentence(self.r.randrange(2, 18)) for _ in range(self.r.choice([1, 1, 2, 4, 8])))

    def attributes(self, names: str, likely: float) -> str:
        r = self.r
        if r.random() > likely:
            return f' class="{r.choice(PLAIN.split())}-{r.randrange(9)}"' if r.random() < 0.3 else ""
        own = r.choice(names.split())
        extra = r.choice(["", "", "site-", "main-", "page-", "c-", "js-", "block-", "u-", "post-", "article-"])
        tail = r.choice(["", "", "", "-box", "-wrap", "-area", "__inner", "-list", "-section", f"-{r.randrange(99)}", "-container"])
        more = f" {r.choice(PLAIN.split())}" if r.random() < 0.3 else ""
        return f' {r.choice(["class", "class", "id", "role" if not extra else "class"])}="{extra}{own}{tail}{more}"'

    def nested(self, inside: str) -> str:
        for _ in range(self.r.choice([0, 0, 0, 1, 2])):
            inside = f"<div{self.attributes(PLAIN, 0.6)}>{inside}</div>"
        return inside

    def other(self, kind: str) -> str:
        r = self.r
        elements, names, phrases = KINDS[kind]
        tag = r.choice(elements.split())
        telling = tag in ("nav", "header", "footer", "aside", "form", "ins")
        say = lambda: OTHER + (r.choice(phrases.split("|")) if r.random() < 0.4 else self.sentence(r.randrange(1, 5)))
        long = lambda: OTHER + (r.choice(phrases.split("|")) + " " if r.random() < 0.3 else "") + self.prose()
        look = r.random()
        if kind == "form":
            inside = "".join(r.choice([f"<label>{say()}</label>", f"<button>{say()}</button>", f"<select><option>{say()}<option>{say()}</select>", f"<p>{say()}</p>", f"<textarea>{long()}</textarea>", "<input name=q>"]) for _ in range(r.randrange(1, 6)))
        elif kind == "comments":
            inside = "".join(f"<{t}{self.attributes('comment reply user text body', 0.5)}>{r.choice(['', f'<h4>{say()}</h4>', f'<b>{say()}</b><br>'])}<p>{long()}</p></{t}>" for t in [r.choice(["li", "div", "article", "p"]) for _ in range(r.randrange(1, 6))])
        elif kind == "menu" or look < 0.35:
            inside = "<ul>" + "".join(f'<li><a href="/{self.word()}">{say()}</a>{r.choice(["</li>", ""])}' for _ in range(r.randrange(1, 9))) + "</ul>"
        elif look < 0.7:
            inside = r.choice([long(), f"<p>{long()}</p>", f"<h3>{say()}</h3><p>{long()}</p>"])
        else:
            inside = "".join(r.choice([f"<p>{say()}</p>", f"<a href=x>{say()}</a>", f"<div>{long()}</div>", f"<span>{say()}</span>"]) for _ in range(r.randrange(1, 5)))
        return f"<{tag}{self.attributes(names, 0.5 if telling else 1.0)}>{self.nested(inside)}</{tag}>"

    def content(self) -> str:
        r = self.r
        t = lambda: CONTENT + self.prose()
        s = lambda: CONTENT + self.sentence(r.randrange(1, 9))
        link = lambda: f'{CONTENT}{self.sentence(4)} <a href="{self.word()}">{self.sentence(3)}</a> <b>{self.sentence(3)}</b> {self.prose()}'
        return r.choice(
            [lambda: f"<p>{t()}</p>"] * 6
            + [lambda: f"<p>{link()}</p>", lambda: f"<p><b>{t()}<br><p>{t()}", lambda: f"<h2>{s()}</h2>", lambda: f"<p>{s()}</p>",
               lambda: "<ul>" + "".join(f"<li>{r.choice([s, t, link])()}</li>" for _ in range(r.randrange(1, 6))) + "</ul>",
               lambda: f"<blockquote><p>{t()}</p></blockquote>", lambda: f"<pre>{t()}</pre>", lambda: f"<figure><img src=x><figcaption>{s()}</figcaption></figure>",
               lambda: "<table>" + "".join(f"<tr><td>{s()}</td><td>{s()}</td></tr>" for _ in range(r.randrange(1, 4))) + "</table>",
               lambda: f"<div>{t()}</div>", lambda: f"<h3>{s()}</h3>", lambda: f"{t()}<br><br>{self.prose()}"]
        )()

    def article(self) -> str:
        r = self.r
        pieces = [f"<h1>{CONTENT}{self.sentence(r.randrange(1, 10))}</h1>"] if r.random() < 0.8 else []
        for _ in range(r.choice([1, 2, 3, 5, 8, 14])):
            pieces.append(self.content())
            if r.random() < 0.08:
                pieces.append(self.other(r.choice(["ad", "sidebar", "share", "form", "notice"])))
        if r.random() < 0.15:
            pieces.append(self.other(r.choice(["comments", "share", "sidebar", "footer"])))
        inside = self.nested("".join(pieces))
        tag = r.choice(["article", "article", "main", "div", "div", "section", ""])
        if not tag:
            return inside
        out = f"<{tag}{self.attributes(BODY, 1.0 if tag in ('div', 'section') else 0.4)}>{inside}</{tag}>"
        return f"<main>{out}</main>" if tag == "article" and r.random() < 0.3 else out

    def html(self) -> str:
        r = self.r
        before = [self.other(k) for k in r.sample(["menu", "header", "ad", "notice", "form", "share"], r.randrange(0, 5))]
        after = [self.other(k) for k in r.sample(["sidebar", "ad", "comments", "footer", "form", "notice", "menu", "share"], r.randrange(0, 6))]
        sides = [self.other("sidebar")] if r.random() < 0.2 else []
        body = "".join([*before, *sides, self.article(), *after])
        body = self.nested(body)
        return f"<html><head><title>x</title></head><body>{body}</body></html>"
