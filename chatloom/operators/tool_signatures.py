"""Tool lists as typed signatures, for templates that describe tools that way.

A tool list belongs to a dataset, not to a row: it is rendered once on the driver and
enters the plan as a literal.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

# Scalar type names, and the indents that the template's line breaks leave.
_SCALARS = {"number": "number", "integer": "number", "boolean": "boolean"}
_ITEM_ARRAYS = {"string": "string[]", **{k: f"{v}[]" for k, v in _SCALARS.items()}}
_PROPERTY_BREAK = "\n" + " " * 16
_DEFAULT_INDENT = " " * 20
_LONGEST_ITEM_TYPE = 50


def _json(value) -> str:
    return json.dumps(value, ensure_ascii=False)


def _or_null(text: str, spec: Mapping) -> str:
    return text + " | null" if spec.get("nullable") else text


def _array(spec: Mapping) -> str:
    items = spec.get("items")
    if not items:
        return _or_null("any[]", spec)
    kind = items.get("type")
    text = _ITEM_ARRAYS.get(kind) if isinstance(kind, str) else None
    if text is None:
        inner = signature_type(items)
        too_wide = inner == "object | object" or len(inner) > _LONGEST_ITEM_TYPE
        text = "any[]" if too_wide else inner + "[]"
    return _or_null(text, spec)


def _variants(variants: Sequence[Mapping]) -> str:
    texts = []
    for variant in variants:
        text = signature_type(variant)
        if variant.get("description"):
            text += "// " + variant["description"]
        if "default" in variant:
            text += f"{_DEFAULT_INDENT}// default: {_json(variant['default'])}"
        texts.append(text)
    return " | \n".join(texts)


def _object(spec: Mapping) -> str:
    properties = spec.get("properties")
    if not properties:
        return "object"
    required = spec.get("required") or []
    fields = [
        f"{name}{'' if name in required else '?'}: {_PROPERTY_BREAK}{signature_type(inner)}"
        for name, inner in properties.items()
    ]
    return "{\n" + ", ".join(fields) + "}"


def signature_type(spec: Mapping) -> str:
    """Type text of one parameter specification; ``any`` when nothing fits."""
    kind = spec.get("type")
    if kind == "array":
        return _array(spec)
    if isinstance(kind, (list, tuple)) and kind:
        return " | ".join(map(str, kind))
    if spec.get("oneOf"):
        return _variants(spec["oneOf"])
    if kind == "string":
        if spec.get("enum"):
            return '"' + '" | "'.join(map(str, spec["enum"])) + '"'
        return _or_null("string", spec)
    if kind == "object":
        return _object(spec)
    return _SCALARS.get(kind, "any") if isinstance(kind, str) else "any"


def _parameter(name: str, spec: Mapping, required: Sequence[str]) -> str:
    comment = f"// {spec['description']}\n" if spec.get("description") else ""
    optional = "" if name in required else "?"
    text = f"{comment}{name}{optional}: {signature_type(spec)}"
    if "default" not in spec:
        return text
    if spec.get("enum"):
        return f"{text}, // default: {spec['default']}"
    if spec.get("oneOf"):
        return f"{text}// default: {spec['default']}"
    return f"{text}, // default: {_json(spec['default'])}"


def tool_signatures(tools: Sequence[Mapping]) -> str:
    """One commented ``type name = (...) => any;`` per tool."""
    blocks = []
    for tool in tools:
        parameters = tool.get("parameters") or {}
        properties = parameters.get("properties")
        arguments = "()"
        if properties:
            required = parameters.get("required") or []
            lines = ",\n".join(_parameter(n, s, required) for n, s in properties.items())
            arguments = "(_: {\n" + lines + "\n})"
        blocks.append(f"// {tool['description']}\ntype {tool['name']} = {arguments} => any;")
    return "\n".join(blocks)
