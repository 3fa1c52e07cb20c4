"""Input schemas, as DDL. Nothing is inferred from data."""

SPACE = "key string, name string, type string"

_BODY = "struct<view: struct<value: string>, storage: struct<value: string>>"
_VERSION = "struct<number: int, `when`: string, message: string, `by`: struct<displayName: string>>"

PAGE = (
    "struct<id: string, title: string, "
    f"version: {_VERSION}, "
    "ancestors: array<struct<id: string, title: string>>, "
    f"body: {_BODY}>"
)

# One landed response per JSON line; `start` is the offset that was asked for.
SPACE_RESPONSES = "start long, results array<struct<key: string, name: string, type: string>>"
PAGE_RESPONSES = (
    f"space_key string, start long, results array<{PAGE}>, page struct<results: array<{PAGE}>>"
)
CHILD_RESPONSES = f"space_key string, parent_id string, start long, results array<{PAGE}>"
VERSION_RESPONSES = f"page_id string, start long, results array<{_VERSION}>"
HISTORY_RESPONSES = f"page_id string, lastUpdated {_VERSION}"
BODY_RESPONSES = f"page_id string, id string, version {_VERSION}, body {_BODY}"
ATTACHMENT_RESPONSES = (
    "page_id string, start long, results array<struct<title: string, mediaType: string, "
    "_links: struct<download: string>>>"
)
PROJECT_RESPONSES = (
    "offset long, projects array<struct<identifier: string, id: long, name: string, "
    "parent: struct<id: long>>>"
)

# <object> rows of an XML export.
_ID = "struct<_VALUE: string, _name: string>"
EXPORT_OBJECT = (
    f"_class string, id {_ID}, "
    f"property array<struct<_VALUE: string, _class: string, _name: string, id: {_ID}>>, "
    f"collection array<struct<_name: string, element: array<struct<id: {_ID}>>>>"
)
