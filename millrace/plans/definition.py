"""One pipeline definition: frozen objects, a builder, and the JSON form.

Definitions are small and live on the driver. Collections of them are tables,
see ``operators.definitions``.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from millrace.operators import definitions as rules
from millrace.operators.validate import MESSAGES


class DefinitionError(ValueError):
    """A definition that cannot be read or does not validate."""


def _short(type_name: str) -> str:
    return type_name.rpartition(".")[2] or type_name


@dataclass(frozen=True)
class Processor:
    name: str
    type: str
    properties: Mapping[str, str] = field(default_factory=dict)
    scheduling: Mapping[str, str] = field(default_factory=dict)
    auto_terminated: Sequence[str] = ()
    id: str | None = None

    @property
    def short_type(self) -> str:
        return _short(self.type)

    def with_id(self, id: str) -> Processor:
        return replace(self, id=id)

    def with_properties(self, properties: Mapping[str, str]) -> Processor:
        """Later values win."""
        return replace(self, properties={**self.properties, **properties})


@dataclass(frozen=True)
class Connection:
    source: str
    destination: str
    relationships: Sequence[str] = tuple(rules.DEFAULT_RELATIONSHIPS)
    back_pressure: Mapping[str, object] = field(default_factory=dict)
    source_id: str | None = None
    destination_id: str | None = None

    def with_ids(self, source_id: str, destination_id: str) -> Connection:
        return replace(self, source_id=source_id, destination_id=destination_id)


@dataclass(frozen=True)
class ControllerService:
    name: str
    type: str
    properties: Mapping[str, str] = field(default_factory=dict)
    id: str | None = None

    def with_id(self, id: str) -> ControllerService:
        return replace(self, id=id)


@dataclass(frozen=True)
class ParameterValue:
    value: str
    sensitive: bool = False
    description: str = ""


@dataclass(frozen=True)
class ParameterContext:
    name: str
    parameters: Mapping[str, ParameterValue] = field(default_factory=dict)
    description: str = ""
    id: str | None = None

    def with_id(self, id: str) -> ParameterContext:
        return replace(self, id=id)

    def with_parameter(self, name: str, value: ParameterValue) -> ParameterContext:
        return replace(self, parameters={**self.parameters, name: value})


@dataclass(frozen=True)
class Port:
    name: str
    port_type: str
    id: str | None = None

    @classmethod
    def input(cls, name: str) -> Port:
        return cls(name, "INPUT")

    @classmethod
    def output(cls, name: str) -> Port:
        return cls(name, "OUTPUT")

    def with_id(self, id: str) -> Port:
        return replace(self, id=id)


def _named(items: Sequence, name: str):
    return next((item for item in items if item.name == name), None)


@dataclass(frozen=True)
class Pipeline:
    name: str
    processors: Sequence[Processor] = ()
    connections: Sequence[Connection] = ()
    services: Sequence[ControllerService] = ()
    contexts: Sequence[ParameterContext] = ()
    ports: Sequence[Port] = ()
    parent_group: str | None = None

    @staticmethod
    def create(name: str) -> PipelineBuilder:
        return PipelineBuilder(name)

    def processor(self, name: str) -> Processor | None:
        return _named(self.processors, name)

    def service(self, name: str) -> ControllerService | None:
        return _named(self.services, name)

    def context(self, name: str) -> ParameterContext | None:
        return _named(self.contexts, name)

    @classmethod
    def from_json(cls, text: str, parent_group: str | None = None) -> Pipeline:
        """Read the JSON form; raises ``DefinitionError`` with the first reject reason."""
        return _read(text, parent_group)

    def to_json(self) -> str:
        """The JSON form, which ``from_json`` and ``parse_definitions`` read."""
        return json.dumps(_written(self), ensure_ascii=False)

    def issues(self, ports: bool = False) -> list[str]:
        """The messages of all validation rules this definition breaks.

        The rules know processors only; with ``ports`` connections from input ports and to
        output ports are in order, too.
        """
        return _issues(self, ports)

    def run(self, spark, inputs: Mapping | None = None):
        from millrace.plans.run import run

        return run(self, spark, inputs)

    def run_stream(self, spark, inputs: Mapping | None = None, **options):
        from millrace.plans.run import run_stream

        return run_stream(self, spark, inputs, **options)


class PipelineBuilder:
    """Collects the parts of a pipeline; every verb returns the builder."""

    def __init__(self, name: str):
        self._pipeline = Pipeline(name)

    def _add(self, part: str, item) -> PipelineBuilder:
        items = (*getattr(self._pipeline, part), item)
        self._pipeline = replace(self._pipeline, **{part: items})
        return self

    def add_processor(
        self,
        name: str,
        type: str,
        properties: Mapping[str, str] | None = None,
        scheduling: Mapping[str, str] | None = None,
        auto_terminated: Sequence[str] = (),
    ) -> PipelineBuilder:
        return self._add(
            "processors",
            Processor(name, type, properties or {}, scheduling or {}, tuple(auto_terminated)),
        )

    def connect(
        self,
        source: str,
        destination: str,
        relationships: Sequence[str] = tuple(rules.DEFAULT_RELATIONSHIPS),
        back_pressure: Mapping[str, object] | None = None,
    ) -> PipelineBuilder:
        return self._add(
            "connections",
            Connection(source, destination, tuple(relationships), back_pressure or {}),
        )

    def with_controller_service(
        self, name: str, type: str, properties: Mapping[str, str] | None = None
    ) -> PipelineBuilder:
        return self._add("services", ControllerService(name, type, properties or {}))

    def with_parameter_context(
        self, name: str, parameters: Mapping[str, str] | None = None, description: str = ""
    ) -> PipelineBuilder:
        plain = {key: ParameterValue(value) for key, value in (parameters or {}).items()}
        return self.with_parameter_context_values(name, plain, description)

    def with_parameter_context_values(
        self,
        name: str,
        parameters: Mapping[str, ParameterValue] | None = None,
        description: str = "",
    ) -> PipelineBuilder:
        return self._add("contexts", ParameterContext(name, parameters or {}, description))

    def with_input_port(self, name: str) -> PipelineBuilder:
        return self._add("ports", Port.input(name))

    def with_output_port(self, name: str) -> PipelineBuilder:
        return self._add("ports", Port.output(name))

    def in_group(self, parent_group: str) -> PipelineBuilder:
        self._pipeline = replace(self._pipeline, parent_group=parent_group)
        return self

    def build(self) -> Pipeline:
        return self._pipeline


def _text(value) -> str:
    """A JSON scalar as text, as Spark writes it."""
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _children(data: Mapping, part: str, required: Sequence[str], reason: str) -> list[Mapping]:
    items = data.get(part) or []
    items = list(items.values()) if isinstance(items, dict) else items
    items = items if isinstance(items, list) else []
    for item in items:
        if not isinstance(item, dict) or any(item.get(name) is None for name in required):
            raise DefinitionError(reason)
    return items


def _texts(item: Mapping, part: str) -> dict[str, str]:
    found = item.get(part)
    return {k: _text(v) for k, v in found.items()} if isinstance(found, dict) else {}


def _parameter(entry) -> ParameterValue:
    if not isinstance(entry, (dict, list)):
        return ParameterValue(_text(entry))
    entry = entry if isinstance(entry, dict) else {}
    return ParameterValue(
        _text(entry.get("value")),
        entry.get("sensitive") not in (None, False, 0, "", "0", [], {}),
        _text(entry.get("description")),
    )


def _read(text: str, parent_group: str | None) -> Pipeline:
    if not text or not text.strip(" \n\r\t\x0b\x00"):
        raise DefinitionError(rules.REASON_BLANK)
    try:
        data = json.loads(text)
    except json.JSONDecodeError:
        data = None
    if not isinstance(data, (dict, list)):
        raise DefinitionError(rules.REASON_NOT_OBJECT)
    data = data if isinstance(data, dict) else {}
    if _text(data.get("name")) == "":
        raise DefinitionError(rules.REASON_NO_NAME)

    def name_of(item: Mapping) -> str:
        return _short(_text(item["type"])) if item.get("name") is None else _text(item["name"])

    build = Pipeline.create(_text(data["name"]))
    for p in _children(data, "processors", ["type"], rules.REASON_PROCESSOR):
        ended = p.get("autoTerminatedRelationships")
        build.add_processor(
            name_of(p),
            _text(p["type"]),
            _texts(p, "properties"),
            _texts(p, "scheduling"),
            [_text(r) for r in ended] if isinstance(ended, list) else (),
        )
    for c in _children(data, "connections", ["source", "destination"], rules.REASON_CONNECTION):
        listed = c.get("relationships")
        carried = (
            [_text(r) for r in listed] if isinstance(listed, list) else rules.DEFAULT_RELATIONSHIPS
        )
        pressure = c.get("backPressure")
        build.connect(
            _text(c["source"]),
            _text(c["destination"]),
            carried,
            pressure if isinstance(pressure, dict) else {},
        )
    for s in _children(data, "controllerServices", ["type"], rules.REASON_SERVICE):
        build.with_controller_service(name_of(s), _text(s["type"]), _texts(s, "properties"))
    for x in _children(data, "parameterContexts", ["name"], rules.REASON_CONTEXT):
        entries = x.get("parameters")
        entries = entries if isinstance(entries, dict) else {}
        build.with_parameter_context_values(
            _text(x["name"]),
            {k: _parameter(v) for k, v in entries.items()},
            _text(x.get("description")),
        )
    for port in _children(data, "ports", ["name"], "Each port must have a name."):
        make = Port.output if port.get("type") == "OUTPUT" else Port.input
        build._add("ports", make(_text(port["name"])))
    if parent_group and parent_group.strip():
        build.in_group(parent_group.strip())
    return build.build()


def _written(p: Pipeline) -> dict:
    def kept(**parts) -> dict:
        return {k: v for k, v in parts.items() if v not in ({}, [], None)}

    def parameter(value: ParameterValue):
        if not value.sensitive and not value.description:
            return value.value
        described = {"description": value.description} if value.description else {}
        return {"value": value.value, "sensitive": value.sensitive, **described}

    return {
        "name": p.name,
        "processors": [
            kept(
                name=n.name,
                type=n.type,
                properties=dict(n.properties),
                scheduling=dict(n.scheduling),
                autoTerminatedRelationships=list(n.auto_terminated),
            )
            for n in p.processors
        ],
        "connections": [
            {
                "source": c.source,
                "destination": c.destination,
                "relationships": list(c.relationships),
                **kept(backPressure=dict(c.back_pressure)),
            }
            for c in p.connections
        ],
        "controllerServices": [
            kept(name=s.name, type=s.type, properties=dict(s.properties)) for s in p.services
        ],
        "parameterContexts": [
            {
                "name": x.name,
                "description": x.description,
                "parameters": {k: parameter(v) for k, v in x.parameters.items()},
            }
            for x in p.contexts
        ],
        "ports": [{"name": port.name, "type": port.port_type} for port in p.ports],
    }


def _issues(p: Pipeline, ports: bool = False) -> list[str]:
    """The messages of all rules; with ``ports`` a connection may also end at a port, as it may in a run."""
    names = {n.name for n in p.processors}
    sources = names | {port.name for port in p.ports if ports and port.port_type == "INPUT"}
    destinations = names | {port.name for port in p.ports if ports and port.port_type == "OUTPUT"}

    def repeats(items: Sequence, rule: str) -> list[str]:
        seen = Counter(item.name for item in items)
        return [MESSAGES[rule] % name for name, n in seen.items() for _ in range(n - 1)]

    found = [] if p.processors else [MESSAGES["empty"]]
    found += repeats(p.processors, "duplicate_processor")
    found += [MESSAGES["missing_type"] % n.name for n in p.processors if n.type == ""]
    for c in p.connections:
        if c.source not in sources:
            found.append(MESSAGES["dangling_source"] % c.source)
        if c.destination not in destinations:
            found.append(MESSAGES["dangling_destination"] % c.destination)
        if not c.relationships:
            found.append(MESSAGES["no_relationships"] % (c.source, c.destination))
    found += repeats(p.services, "duplicate_service")
    return found + repeats(p.contexts, "duplicate_context")
