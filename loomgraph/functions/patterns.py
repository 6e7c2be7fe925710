"""Catalogue of extraction patterns: a regular expression, its groups, and the triples that a match emits.

An emit names its subject, relation and object; "$k" stands for group k, and "$k," for the parts of group k between
commas. A triple with an empty part is not emitted.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Pattern:
    category: str
    regex: str
    groups: int
    emits: tuple[tuple[str, str, str], ...]
    confidence: float


# Categories in order, their expressions (case-insensitive) and confidences.
CATALOGUE = (
    Pattern("class_definition", r"\bclass\s+(\w+)(?:\s+extends\s+(\w+))?(?:\s+implements\s+([\w,\s]+))?", 3,
            (("$1", "isTypeOf", "Class"), ("$1", "extends", "$2"), ("$1", "implements", "$3,")), 0.9),
    Pattern("interface_definition", r"\binterface\s+(\w+)(?:\s+extends\s+([\w,\s]+))?", 2,
            (("$1", "isTypeOf", "Interface"), ("$1", "extends", "$2,")), 0.9),
    Pattern("method_definition", r"\b(?:public|private|protected)?\s*(?:static)?\s*(\w+)\s+(\w+)\s*\([^)]*\)", 2,
            (("$2", "hasReturnType", "$1"), ("$2", "isTypeOf", "Method")), 0.8),
    Pattern("method_call", r"(\w+)\.(\w+)\s*\(", 2, (("$1", "hasMethod", "$2"),), 0.7),
    Pattern("instantiation", r"new\s+(\w+)\s*\(", 1, (("Code", "instantiates", "$1"),), 0.75),
    Pattern("collection_usage", r"\b(ArrayList|HashMap|HashSet|LinkedList|TreeMap|Vector|Stack|Queue)\b", 1,
            (("$1", "isTypeOf", "Collection"), ("$1", "belongsTo", "JavaCollections")), 0.85),
    Pattern("data_types", r"\b(String|int|double|float|boolean|char|long|byte|short)\b", 1,
            (("$1", "isTypeOf", "DataType"), ("$1", "belongsTo", "JavaPrimitives")), 0.9),
    Pattern("exception_handling", r"\b(?:try|catch|finally|throw|throws)\b.*?\b(\w+(?:Exception|Error))\b", 1,
            (("$1", "isTypeOf", "Exception"), ("Code", "handles", "$1")), 0.8),
    Pattern("annotations", r"@(\w+)", 1, (("$1", "isTypeOf", "Annotation"), ("Code", "uses", "$1")), 0.85),
    Pattern("imports", r"\bimport\s+([\w.]+)\.(\w+)", 2, (("$2", "belongsTo", "$1"), ("Code", "imports", "$2")), 0.75),
    Pattern("spring_concepts", r"@(Controller|Service|Repository|Component|Entity|RestController)", 1,
            (("$1", "isTypeOf", "SpringAnnotation"), ("$1", "belongsTo", "SpringFramework")), 0.8),
    Pattern("web_concepts", r"\b(REST|HTTP|JSON|XML|API|GET|POST|PUT|DELETE)\b", 1,
            (("$1", "isTypeOf", "WebConcept"), ("$1", "belongsTo", "WebDevelopment")), 0.7),
    Pattern("design_patterns", r"\b(Singleton|Factory|Observer|Strategy|Builder|Adapter)\b", 1,
            (("$1", "isTypeOf", "DesignPattern"), ("$1", "belongsTo", "SoftwareDesign")), 0.75),
)
BY_NAME = {p.category: p for p in CATALOGUE}

# Concept words looked for by the scrape report, as whole words in any case.
CONCEPTS = (
    "class", "interface", "public", "private", "static", "final", "extends", "implements", "String", "int", "double",
    "boolean", "ArrayList", "HashMap", "Exception",
)
# Words that make an entity name plausible to the validator.
ENTITY_WORDS = (
    "method", "function", "variable", "parameter", "argument", "class", "interface", "enum", "annotation", "package",
    "exception", "error", "handler", "listener", "event", "thread", "process", "service", "controller", "model", "view",
    "component", "module", "library", "framework", "api", "rest", "http", "json", "xml", "sql", "database",
)
