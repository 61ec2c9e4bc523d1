"""Repository URLs as column expressions: the whole rule stays in generated code, no Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# First path segments of the code host that name pages of the host, not accounts.
RESERVED_OWNERS = (
    "orgs", "sponsors", "about", "features", "marketplace", "topics", "search", "settings", "apps", "collections",
    "events", "pricing", "security", "site", "support", "trending", "explore", "notifications", "login", "join",
    "contact", "enterprise", "customer-stories", "readme", "copilot", "pulls", "issues", "notices", "government",
)

# URL schemes whose last path segment may carry ";parameters".
PARAM_SCHEMES = ("", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel")

def _pattern(host: str, www: bool, reserved: Sequence[str], params: bool) -> str:
    """A Java pattern whose groups 1 and 2 are owner and repository; params: for the schemes that cut ";parameters"."""
    schemes = "|".join(x.replace("+", r"\+") for x in PARAM_SCHEMES if x)
    scheme = rf"(?:(?i:{schemes}):)?" if params else rf"(?!(?i:{schemes}):)[A-Za-z][A-Za-z0-9+.\-]*:"
    netloc = ("(?i:www[.])?" if www else "") + "(?i:" + host.replace(".", "[.]") + ")"
    end = r"(?U:[\s\x1c-\x1f]*)$"
    cut = rf"|;[^/?#]*(?:[?#]|{end})" if params else ""
    names = "|".join(x.replace("-", r"\-") for x in reserved)
    owner = (rf"(?!(?i:{names})/)" if reserved else "") + "([^/?#]+)"
    repo = rf"(?!(?:\.git)?(?:[/?#]|{end}{cut}))([^/?#]+?)(?:\.git)?(?:[/?#].*|{end}{cut}.*)"
    return rf"(?s)^(?U:[\s\x00-\x1f]*){scheme}//{netloc}/+{owner}/+{repo}$"


def repo_url(url: Column, host: str = "github.com", www: bool = True, reserved: Sequence[str] = RESERVED_OWNERS) -> Column:
    """Canonical https://{host}/{owner}/{repo} of a repository link, or NULL if it names none.

    The host must match exactly (any letter case; a port or user info fails), the scheme doesn't matter, the first two
    non-empty path segments name owner and repository, one ".git" suffix is cut, letter case is kept. NULL stays NULL.
    """
    u = F.translate(url, "\t\r\n", "")
    for params in (True, False):  # a text matches one of the patterns at most; matched texts are marked
        u = F.regexp_replace(u, _pattern(host, www, reserved, params), "\u0001$1/$2")
    return F.concat(F.lit(f"https://{host}/"), F.nullif(F.regexp_extract(u, "(?s)^\u0001(.*)$", 1), F.lit("")))


def owner_and_repo(url: Column, host: str = "github.com") -> tuple[Column, Column]:
    """Owner and repository found anywhere in a text, as a lookup against a REST API needs them; NULL if absent."""
    pattern = host.replace(".", r"\.") + r"/([^/]+)/([^/#?]+)"
    owner, repo = (F.regexp_extract(url, pattern, k) for k in (1, 2))
    return F.nullif(owner, F.lit("")), F.nullif(F.regexp_replace(repo, r"\.git$", ""), F.lit(""))
