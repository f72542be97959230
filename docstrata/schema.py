"""Schemas of the document model (Spark DDL) and its closed vocabularies."""

from __future__ import annotations

ELEMENT_TYPES = ("section", "heading", "paragraph", "list", "list_item", "table", "figure", "caption", "header", "footer", "other")
#: Converter label -> element type, element type -> code used in ids.
LABEL_TYPES = {
    "section_header": "heading", "title": "heading", "text": "paragraph", "paragraph": "paragraph", "list_item": "list_item",
    "table": "table", "picture": "figure", "caption": "caption", "page_header": "header", "page_footer": "footer",
}
TYPE_CODES = {"heading": "hdg", "paragraph": "txt", "list_item": "lst", "table": "tbl", "figure": "img", "caption": "cap", "header": "hdr", "footer": "ftr"}

BBOX = "struct<left:double,top:double,right:double,bottom:double,coordinate_origin:string>"
PROVENANCE = f"array<struct<page:int,bbox:{BBOX},source:string,confidence:double>>"
ELEMENT = f"struct<id:string,document_id:string,type:string,text:string,reading_order:int,parent_id:string,children_ids:array<string>,heading_level:int,provenance:{PROVENANCE},metadata:struct<docling_label:string,traversal_level:int>>"
DOCUMENT = f"id string, source_name string, source_sha256 string, page_count int, elements array<{ELEMENT}>, root_ids array<string>"
CELL = "struct<text:string,row:int,column:int,row_span:int,column_span:int,is_header:boolean>"
TABLE = f"id string, document_id string, page int, method string, caption string, bbox {BBOX}, cells array<{CELL}>, num_rows int, num_columns int, source_element_id string, files map<string,string>"
RAW_ITEM = "doc_key string, pos bigint, label string, text string, level int, traversal_level int, prov array<struct<page:int,bbox:" + BBOX + ">>"
FINDING = "document_id string, severity string, code string, message string, element_id string, page int"
RAW_TABLE = f"prov array<struct<page:int,bbox:{BBOX}>>, cells array<struct<start_row:int,end_row:int,start_col:int,end_col:int,text:string,column_header:boolean,row_header:boolean>>, num_rows int, num_cols int"
RAW_PICTURE = f"page int, bbox {BBOX}, ocr_text string, content binary, width int, height int, rgb binary"
CONVERSION = (
    "doc_key string, source string, content_sha256 string, page_count int, status string, errors array<string>, duration_seconds double, python_version string, converter_version string, config string, "
    f"items array<struct<label:string,text:string,level:int,traversal_level:int,prov:array<struct<page:int,bbox:{BBOX}>>>>, tables array<struct<{{tables}}>>, pictures array<struct<{{pictures}}>>, raw map<string,string>"
)


def _as_struct(ddl: str) -> str:
    """Columns as the fields of a struct: the first blank of each becomes a colon."""
    return ",".join(part.replace(" ", ":", 1) for part in ddl.split(", "))


CONVERSION = CONVERSION.format(tables=_as_struct(RAW_TABLE), pictures=_as_struct(RAW_PICTURE))
