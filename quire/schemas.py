"""Declared schemas of the landed responses and of the outputs (JSON is
never read with schema inference)."""

from __future__ import annotations

SPACE = "id string, key string, name string, homepageId string, type string, status string"
PAGE = ("id string, title string, spaceId string, status string, body struct<storage:struct<value:string>>, "
        "version struct<createdAt:string>, _links struct<webui:string>")
CHILD = "parent_id string, id string"
ATTACHMENT = ("id string, title string, mediaType string, pageId string, fileId string, webuiLink string, "
              "downloadLink string, version struct<createdAt:string>, status string")

WIKI_LIST_RESPONSE = "request_path string, _links struct<next:string>, results array<struct<{}>>"

ISSUE = ("id string, key string, fields struct<issuetype:struct<name:string>, project:struct<id:string,name:string,"
         "key:string>, labels:array<string>, summary:string, created:string, updated:string, "
         "attachment:array<struct<mimeType:string,filename:string,created:string,content:string>>, "
         "comment:struct<comments:array<struct<id:string>>>, status:struct<name:string>, "
         "sprint_open:boolean, epic_link:string, fix_versions:array<string>>, custom map<string,string>, "
         "renderedFields struct<description:string>")
ISSUE_SEARCH_RESPONSE = f"request string, startAt long, maxResults long, total long, issues array<struct<{ISSUE}>>"
COMMENT = "author struct<displayName:string>, renderedBody string, created string, updated string"
COMMENTS_RESPONSE = (f"issue_key string, startAt long, maxResults long, total long, "
                     f"comments array<struct<{COMMENT}>>")
TEST_STEP = "orderId long, step string, data string, result string"
TEST_STEPS_RESPONSE = f"issue_key string, testSteps array<struct<{TEST_STEP}>>"
WEB_PAGE = "url string, html string, fetched_at string"
DATASET_DOCUMENTS_RESPONSE = "dataset_id string, page long, has_more boolean, data array<struct<id:string>>"

DOCUMENT_OUT = "crawl_target string, filename string, mime_type string, body string"
