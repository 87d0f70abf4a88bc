"""Explicit schemas of what is read; nothing is inferred."""

from pyspark.sql import types as T

_NUMBERS = T.ArrayType(T.DoubleType())
BLOCK = T.StructType(
    [
        T.StructField("block_label", T.StringType()),
        T.StructField("block_content", T.StringType()),
        T.StructField("block_bbox", _NUMBERS),
        T.StructField("image_bbox", _NUMBERS),
        T.StructField("pdf_bbox", _NUMBERS),
        T.StructField("block_id", T.IntegerType()),
        T.StructField("block_order", T.DoubleType()),
        T.StructField("text_length", T.IntegerType()),
        T.StructField("font_size", T.DoubleType()),
        T.StructField("is_bold", T.BooleanType()),
        T.StructField("font_name", T.StringType()),
        T.StructField("inside_box", T.BooleanType()),
        T.StructField("box_id", T.IntegerType()),
    ]
)
LAYOUT = T.StructType(
    [
        T.StructField("input_path", T.StringType()),
        T.StructField("page_index", T.IntegerType()),
        T.StructField("page_count", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("image_width", T.IntegerType()),
        T.StructField("image_height", T.IntegerType()),
        T.StructField("pdf_width", T.DoubleType()),
        T.StructField("pdf_height", T.DoubleType()),
        T.StructField("parsing_res_list", T.ArrayType(BLOCK)),
    ]
)
TREE_NODE = "id string, type string, level int, number int, branch int, marker string, title string, content string, page int, metadata map<string,string>, children array<string>, references array<string>"
