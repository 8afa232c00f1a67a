"""Fixed values shared by expressions, the dump source and the HTML rules: hosts, words and patterns.

They have to be as they are for right results. Patterns hold in Java and in Python.
"""

from __future__ import annotations

#: Hosts whose links count as social.
SOCIAL_HOSTS = ("facebook.com", "twitter.com", "x.com", "linkedin.com", "instagram.com", "youtube.com", "t.me", "pinterest.com", "reddit.com", "threads.net", "mastodon.social", "bsky.app")
#: Endings of image files.
IMAGE_ENDINGS = ("png", "jpg", "jpeg", "gif", "webp", "svg")
#: Maintenance categories that are no tags.
SKIPPED_CATEGORIES = ("Category", "Articles", "Pages", "Webarchive", "CS1", "All ", "Use ", "Commons category", "Short description", "Wikipedia")
#: Parts of raw pages: title and what is cut from it, canonical url, category links, images and their source.
TITLE = r"(?i)<title>([^<]+)</title>"
SITE_IN_TITLE = r"\s*[-–—]\s*Wikipedia\s*$"
CANONICAL = r"(?i)<link[^>]*rel=[\"']canonical[\"'][^>]*href=[\"']([^\"']+)[\"']"
CATEGORY = r"(?i)<a[^>]*href=[\"'](?:https?://[^/]*)*/wiki/Category:[^\"']+[\"'][^>]*>([^<]+)</a>"
IMG = r"(?i)<img\b[^>]*>"
SRC = r"(?i)\bsrc=[\"']([^\"']+)[\"']"
#: Path of a thumbnail in wiki media.
THUMB = r"/thumb/(.*)/\d+px-[^/]+$"
#: Hosts of wikis.
WIKI_HOSTS = r"(?i)(?:wikipedia\.org|wikimedia\.org|mediawiki\.org|wiktionary\.org|wikiquote\.org|wikisource\.org|wikibooks\.org|fandom\.com|wiki\..*\.org)"
#: Endings of stub categories.
STUBS = r"(?i)stubs?$|小作品$|スタブ$"
#: Characters that show nothing.
INVISIBLE = "[\ufeff\u200b-\u200f\u202a-\u202e\u2060\u2061]"
#: Chinese, Japanese and Korean characters and their punctuation.
CJK = "[\u4e00-\u9fff\u3400-\u4dbf\u3000-\u303f\u3040-\u309f\u30a0-\u30ff\uac00-\ud7af]"
#: A block of front matter at the start.
FRONT_MATTER = r"\A---[ \t]*\r?\n[\s\S]*?\r?\n---[ \t]*(?:\r?\n+)?"
