"""Fixed values of the cleaning and conversion rules: words, selectors, tags and patterns.

They define which elements are content and which are not, and are given in their natural order.
"""

from __future__ import annotations

import re

from millrace.functions import fixed
from millrace.functions.fixed import SOCIAL_HOSTS  # noqa: F401 - part of the rules

_EDGE = r"(?<![a-z0-9\-])(?:%s)(?![a-z0-9\-])"
#: Words that name boilerplate.
NOISE_WORDS = (
    "ad ads advert banner cookie consent copyright disclaimer newsletter promo sidebar subscribe sponsor breadcrumb sponsored marketing subscription "
    "comment comments commentform comment-form comment-respond reply respond headerbar navbar navbox quick-links breadcrumbs search-box action-bar "
    "pagination postprofile actions-jump jumpbox nav-breadcrumbs linklist navlinks topic-actions post-buttons rightside dropdown-contents hatnote "
    "headerlink navigation toolbar external-links catlinks trust-badge printfooter"
).split()
NOISE_NAME = re.compile(_EDGE % "|".join(NOISE_WORDS), re.I)
#: First words of boilerplate module classes.
MODULE_WORDS = "toolbar sidebar banner cookie consent subscribe newsletter ad ads advert navigation navbar comment sign-off".split()
NOISE_MODULE = re.compile(rf"^(?:{'|'.join(MODULE_WORDS)})-module(?![a-z0-9\-])", re.I)
#: Words of test ids that name boilerplate.
TEST_ID_WORDS = frozenset(
    "ad ads advert banner cookie consent copyright disclaimer newsletter promo sidebar subscribe sponsor toolbar navbar navigation comment pagination licence license".split()
)
TEST_ID_PART = re.compile(r"[A-Z][a-z]*|[a-z]+|[0-9]+")
#: Tags that are never content.
STRIPPED = frozenset("iframe ins svg nav footer aside".split())
STRIPPED_EARLY = ("script", "style", "noscript")
#: Attributes of ads.
AD_ATTRIBUTES = frozenset(("data-ad", "data-ads", "data-advertisement"))
RESPONSIVE_ATTRIBUTES = frozenset(("data-last-responsive", "data-skip-responsive"))
#: Class of a forum post.
POST_NAME = re.compile(r"(?<![a-z0-9])(?:post|message|postbody)(?![a-z0-9])", re.I)
#: Inline elements.
INLINE_PARENTS = frozenset("sup sub span em strong b i u code small mark abbr cite".split())
#: Texts of jump links.
NAV_PREFIXES = ("jump to", "skip to", "go to", "scroll to", "跳转到", "跳轉到", "跳到", "跳至", "前往", "转到", "轉到")
NAV_PHRASES = frozenset(("top", "back to top", "顶部", "頂部", "回到顶部", "回到頂部", "返回顶部", "返回頂部"))
#: Text of a correction button, and characters that make content.
CORRECTION_BUTTON = re.compile(r"^\s*【纠错】\s*$")
LEAST_CONTENT = 50

#: Where an article may stand, in tiers; ``.x`` is a class, ``#x`` an id, ``x=y`` an attribute, else a tag.
CONTENT = (
    "itemprop=articleBody .post-content .post_content .postcontent .postContent .article-content .article__content .article-body .article__body .entry-content #entry-content #article-content #article-body .post-text .post_text .post-body .post-entry .postentry",
    "article",
    ".storycontent .story-content .story-body .blog-content .section-content .single-content .theme-content .page-content .text-content .body-text .body-content #story .story .field-body role=article .wpb_text_column .mw-body-content #bodyContent #detail .rm_txt_con",
    ".content-main .content_main .main-content .content-body .content__body #content-main #content-body #contentBody #content #Content .content",
    "main role=main",
)

#: Headings of reference sections, lower case.
REFERENCE_HEADINGS = frozenset(
    (
        "references", "notes", "external links", "further reading", "bibliography", "citations", "footnotes", "see also",
        "参考文献", "参考资料", "参考来源", "引用", "注释", "脚注", "外部链接", "外部連結", "延伸阅读", "参见", "參考文獻", "參考資料", "參考來源", "參考资料", "註釋", "注釋", "注释说明", "腳註", "延伸閱讀", "參見", "相關條目", "相关条目",
        "参照", "出典", "外部リンク", "関連項目", "각주", "참고 문헌", "외부 링크",
        "einzelnachweise", "weblinks", "literatur", "anmerkungen", "fußnoten", "quellen",
        "références", "notes et références", "liens externes", "bibliographie",
        "referencias", "notas", "enlaces externos", "bibliografía", "lecturas adicionales", "véase también",
        "referências", "ligações externas", "leitura adicional", "примечания", "ссылки", "литература", "библиография",
        "note", "collegamenti esterni", "voci correlate", "bibliografia", "مراجع", "وصلات خارجية", "ملاحظات", "مصادر", "لينكات",
        "referenties", "externe links", "bronnen", "voetnoten", "przypisy", "linki zewnętrzne", "referenser", "externa länkar", "fotnoter",
        "tham khảo", "liên kết ngoài", "chú thích", "примітки", "посилання", "джерела", "література", "منابع", "پانویس", "پیوند به بیرون",
        "mga reperensya", "mga sumpay sa gawas", "mga sumpay ha gawas", "pinanbasaran",
    )
)

#: Tags and attributes of simple HTML.
SIMPLE_TAGS = frozenset(
    "h1 h2 h3 h4 h5 h6 p blockquote pre hr strong b em i u s del ins code mark sub sup br ul ol li table thead tbody tfoot tr th td caption img figure figcaption audio video source a".split()
)
SIMPLE_ATTRIBUTES = frozenset("href src alt srcset colspan rowspan poster controls type".split())
SIMPLE_VOID = frozenset("img br hr input meta link source".split())
#: Endings of image files.
IMAGE_ENDINGS = tuple(f".{x}" for x in fixed.IMAGE_ENDINGS)
WIKI_HOST = re.compile(fixed.WIKI_HOSTS)
TITLE_CLASSES = ("entry-title", "post-title", "topic-title", "article-title", "page-title")
STUB_CATEGORY = re.compile(fixed.STUBS)
INVISIBLE = re.compile(fixed.INVISIBLE)
CJK = re.compile(fixed.CJK)
#: Fixed form: a thumbnail file begins with its width.
THUMBNAIL = re.compile(r"\d+px-")
ARROWS = {"increase": "↑", "decrease": "↓", "steady": "→"}
NOT_RELATIVE = ("#", "data:", "mailto:", "tel:", "javascript:", "http://", "https://", "//")
LOCAL_PREFIXES = ("images/", "media/")
