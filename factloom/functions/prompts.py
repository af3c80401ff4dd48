"""Requests to the model, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What each stage asks; only the form of the answer is fixed.
SYSTEM = {
    "elicitation": 'List what is known about the subject as JSON: {"facts": [{"subject": ..., "predicate": ..., "object": ...}]}. Use instanceOf for its classes.',
    "ner": 'Say whether the phrase is a named entity. Answer with JSON: {"phrase": ..., "is_ne": true or false}.',
    "ned1": "Choose the option that the target stands for in the statement. Answer with one letter.",
    "nedg": 'Describe the entity in one sentence as meant in the statement. Begin with "Description: ".',
    "ned2": "Choose the option that is the described target. Answer with one letter.",
    "pd": "Choose the option with the meaning of the relation in the statement. Answer with one letter.",
    "pdg": 'Describe the relation in one sentence. Begin with "Description: ".',
    "cd": "Choose the option that is the class of the statement. Answer with one letter.",
    "cdg": 'Describe the class in one sentence. Begin with "Description: ".',
}
#: Most output tokens, effort and temperature of each stage.
LIMITS = {
    "elicitation": (8196, "none", 0), "ner": (256, "minimal", None), "ned1": (128, "minimal", None), "nedg": (128, "none", 0), "ned2": (128, "minimal", None),
    "pd": (128, "minimal", None), "pdg": (128, "none", 0), "cd": (128, "minimal", None), "cdg": (128, "none", 0),
}


def text(*parts: Column | str) -> Column:
    """The parts in one; a null part is empty."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def statement(subject: Column, predicate: Column, obj: Column) -> Column:
    return text("[", subject, ", ", predicate, ", ", obj, "]")


def options(candidates: Column, what: str, *fixed: str) -> Column:
    """Lettered options from an array of ``struct<label, description>``, then the fixed ones."""
    lines = F.transform(candidates, lambda c, i: text(F.char(i + 65), f'. {what}: "', c["label"], '" (', c["description"], ")"))
    return F.array_join(F.concat(lines, F.array(*[F.lit(x) for x in fixed])), "\n")


NONE, UNSURE = "F. None of above.", "G. Unsure"


def elicitation(label: Column, description: Column) -> Column:
    return text("Subject: ", label, "\nDescription of subject: ", description)


def ner(subject: Column, predicate: Column, obj: Column) -> Column:
    return text("Phrase: ", obj, " | Statement: ", statement(subject, predicate, obj))


def ned1(subject: Column, predicate: Column, obj: Column, candidates: Column) -> Column:
    return text("Target: ", obj, "\nStatement: ", statement(subject, predicate, obj), "\nOptions:\n", options(candidates, "Entity", NONE, UNSURE))


def nedg(subject: Column, predicate: Column, obj: Column) -> Column:
    return text("Entity: ", obj, "\nStatement: ", statement(subject, predicate, obj))


def ned2(obj: Column, description: Column, candidates: Column) -> Column:
    return text("Target: ", obj, "\nDescription: ", description, "\nOptions:\n", options(candidates, "Entity", NONE))


def pd(subject: Column, predicate: Column, obj: Column, candidates: Column) -> Column:
    return text("Relation: ", predicate, "\nStatement: ", statement(subject, predicate, obj), "\nOptions:\n", options(candidates, "Relation", NONE))


def pdg(subject: Column, predicate: Column, obj: Column) -> Column:
    """A label of one character says too little alone, so its statement is added."""
    return F.when(F.length(predicate) > 1, text("Relation: ", predicate)).otherwise(text("Relation: ", predicate, "\nStatement: ", statement(subject, predicate, obj)))


def cd(subject: Column, predicate: Column, obj: Column, candidates: Column) -> Column:
    return text("Class: ", obj, "\nStatement: ", statement(subject, predicate, obj), "\nOptions:\n", options(candidates, "Class", NONE))


def cdg(obj: Column) -> Column:
    return text("Class: ", obj)


#: Forms of answers: the facts of an elicitation strictly as their schema says, an object, or text.
_TEXT = {"type": "string"}
_FACT = {"type": "object", "properties": {"subject": _TEXT, "predicate": _TEXT, "object": _TEXT}, "required": ["subject", "predicate", "object"], "additionalProperties": False}
_FACTS = {"type": "object", "properties": {"facts": {"type": "array", "items": _FACT}}, "required": ["facts"], "additionalProperties": False}
FORMS = {"elicitation": {"type": "json_schema", "name": "facts", "strict": True, "schema": _FACTS}, "ner": {"type": "json_object"}}


def literal(value: object) -> Column:
    """A Python value as a column: dictionaries as structs, lists as arrays."""
    if isinstance(value, dict):
        return F.struct(*[literal(v).alias(k) for k, v in value.items()])
    return F.array(*[literal(v) for v in value]) if isinstance(value, list) else F.lit(value)


def request(stage: str, ident: Column, user: Column, model: str = "model") -> Column:
    """One request line as JSON."""
    tokens, effort, temperature = LIMITS[stage]
    body = [
        F.lit(model).alias("model"),
        F.array(F.struct(F.lit("developer").alias("role"), F.lit(SYSTEM[stage]).alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content"))).alias("input"),
        F.struct(F.lit(effort).alias("effort")).alias("reasoning"),
        F.struct(F.lit("low").alias("verbosity"), literal(FORMS.get(stage, {"type": "text"})).alias("format")).alias("text"),
        F.lit(tokens).alias("max_output_tokens"),
    ]
    if temperature is not None:
        body.append(F.lit(temperature).alias("temperature"))
    return F.to_json(F.struct(ident.alias("custom_id"), F.lit("POST").alias("method"), F.lit("/v1/responses").alias("url"), F.struct(*body).alias("body")))


def chat_request(line: Column, merge_system: bool = False, structured: bool = True, extra: dict | None = None, **overrides: str | int | float) -> Column:
    """A request line as a chat request: developers become systems, or, merged, the beginning of the first user message, which is
    added where there is none.

    ``structured`` keeps the form of the answer, a schema with its keys in alphabetical order; ``extra`` are further fields of the body.
    """
    read = F.from_json(line, "custom_id string, body struct<model:string,input:array<struct<role:string,content:string>>,max_output_tokens:int,temperature:double,text:struct<format:struct<type:string,name:string,strict:boolean>>>")
    messages = F.transform(read["body"]["input"], lambda m: F.struct(F.when(m["role"] == "developer", "system").otherwise(m["role"]).alias("role"), m["content"].alias("content")))
    if merge_system:
        systems = F.array_join(F.transform(F.filter(messages, lambda m: m["role"] == "system"), lambda m: m["content"]), "\n\n")
        rest = F.filter(messages, lambda m: m["role"] != "system")
        first = F.array_position(F.transform(rest, lambda m: m["role"]), "user") - 1
        merged = F.transform(rest, lambda m, i: F.struct(m["role"].alias("role"), F.when(i == first, F.concat(systems, F.lit("\n\n"), m["content"])).otherwise(m["content"]).alias("content")))
        alone = F.array(F.struct(F.lit("user").alias("role"), systems.alias("content")))
        messages = F.when(systems == "", rest).when(first < 0, F.concat(alone, rest)).otherwise(merged)
    fields = {"model": read["body"]["model"], "messages": messages, "max_tokens": read["body"]["max_output_tokens"], "temperature": read["body"]["temperature"]}
    if structured:
        form = read["body"]["text"]["format"]
        schema = F.try_parse_json(F.get_json_object(line, "$.body.text.format.schema"))
        named = F.when(form["type"] == "json_schema", F.struct(form["name"].alias("name"), schema.alias("schema"), F.coalesce(form["strict"], F.lit(False)).alias("strict")))
        fields["response_format"] = F.when(form["type"].isin("json_schema", "json_object"), F.struct(form["type"].alias("type"), named.alias("json_schema")))
    fields |= {k: F.lit(v) for k, v in overrides.items()} | {k: literal(v) for k, v in (extra or {}).items()}
    body = F.struct(*[c.alias(k) for k, c in fields.items()])
    return F.to_json(F.struct(read["custom_id"].alias("custom_id"), F.lit("POST").alias("method"), F.lit("/v1/chat/completions").alias("url"), body.alias("body")))
