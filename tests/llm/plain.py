"""The line rules of operator 1 written plainly, as brute force for tests."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PHRASES = """accept all cookies/add to cart/all rights reserved/back to top/click here to/cookie policy/enable javascript/follow us on/leave a comment/leave a reply/log in to comment/lorem ipsum/page not found/powered by wordpress
privacy policy/read more/related posts/share on facebook/share on twitter/sign up for our newsletter/skip to content/subscribe to our/terms of service/terms of use/this site uses cookies/view cart""".replace("\n", "/").split("/")
MENU = "about back blog contact faq forward help home login logout menu next news previous register search share sitemap top".split()


def line_fails(line: str) -> bool:
    words = WORD.findall(line)
    if not words:
        return False
    solid = "".join(words)
    symbols = [c for c in line if c in "#*$%&|<>"]
    marks = [c for c in solid if c.isascii() and not c.isalnum() and c.isprintable()]
    if len(symbols) > len(words) or 3 * len(marks) > 2 * len(solid):
        return True
    separators = [c for c in line if c in "|\u00bb\u203a>\u00b7\u2022"]
    if len(separators) >= 3 and 3 * len(separators) >= len(words):
        return True
    low = "".join(c.lower() if c.isascii() else c for c in line)
    if len(words) <= 4 and set(WORD.findall(low)) <= set(MENU) and solid[-1] not in ".!?:;,\"'\u201d\u2019\u00bb\u2026)]\u3002\uff01\uff1f":
        return True
    found = sum(len(re.findall(re.escape(p), low)) for p in PHRASES)
    return found > 0 and len(words) <= 12 * found
