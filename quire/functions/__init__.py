"""Column expressions (pure, codegen-friendly) used by the operators."""

from quire.functions.text import (  # noqa: F401
    basename, collapse_spaces, file_name, js_number, sanitize_filename, truncate_filename,
)
from quire.functions.urls import (  # noqa: F401
    attachment_url, issue_url, normalize_url, resolve_href, url_id, wiki_page_url,
)
from quire.functions.html import (  # noqa: F401
    attachment_refs, decode_entities, href_list, page_title,
)
