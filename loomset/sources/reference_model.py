"""The sample model written in code: three packages, sixteen classes, and the kind of thing each class is."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..plans.model import Model
from .models import PackageSource, assoc, attr, cls, cref, from_code

# The packages with their ids, and the names, types and ends of their classes. Attributes are strings unless they say otherwise.
PACKAGES = {"GridCore": "power.grid.core", "GridEquipment": "power.equipment", "TransformerPackage": "power.equipment.transformer"}
CORE = [
    cls("Asset", "Something of value that a grid operator owns or runs.", attributes=[attr("assetId", required=True, description="Identifies the asset."), attr("name", description="What people call it."), attr("status", description="Where it stands in its life.")]),
    cls("Location", "A place, on the map or in the network, where assets stand.", attributes=[attr("locationId", required=True), attr("name"), attr("geoCoordinates", description="Coordinates, with their system if it isn't the usual one.")]),
    cls("Organization", "A company or part of one that takes part in running the grid.", attributes=[attr("organizationId", required=True), attr("name", required=True), attr("role", description="What it does there, such as operating or maintaining.")]),
    cls("Equipment", "An asset with an electrical or supporting function.", attributes=[attr("equipmentId", required=True), attr("name"), attr("operatingStatus", description="Whether it is in service."), attr("commissioningDate", "xsd:date")]),
    cls("Measurement", "An observed value of a quantity.", attributes=[attr("measurementId", required=True), attr("measurementType", description="The quantity, such as voltage."), attr("unit"), attr("value", "xsd:double"), attr("timestamp", "xsd:dateTime")]),
    cls("Work", "A task that is done on assets.", attributes=[attr("workId", required=True), attr("workType", description="The kind of task, such as inspection."), attr("plannedStart", "xsd:dateTime"), attr("plannedEnd", "xsd:dateTime"), attr("status")]),
    cls("Event", "Something that happened and matters to operation.", attributes=[attr("eventId", required=True), attr("eventType", description="What happened, such as a fault."), attr("occurredAt", "xsd:dateTime"), attr("severity")]),
]
_EQUIPMENT = [cref("GridCore", "Equipment")]
EQUIPMENT = [
    cls("Transformer", "Passes energy between circuits by induction.", _EQUIPMENT, [attr("ratedCapacity", "xsd:double", description="Apparent power in MVA."), attr("primaryVoltage", "xsd:double", description="In kV."), attr("secondaryVoltage", "xsd:double", description="In kV."), attr("manufacturer"), attr("windingType", description="How many windings, and of what kind.")],
        [assoc("installedIn", "GridCore", "Location", "0..1"), assoc("operatedBy", "GridCore", "Organization", "0..1")]),
    cls("Breaker", "Switches currents, also those of faults.", _EQUIPMENT, [attr("ratedCurrent", "xsd:double", description="In A."), attr("breakingCapacity", "xsd:double", description="In kA."), attr("mechanism"), attr("isOpen", "xsd:boolean")]),
    cls("Line", "Overhead conductors between two places.", _EQUIPMENT, [attr("length", "xsd:double", description="In km."), attr("conductorType"), attr("ratedCurrent", "xsd:double", description="In A.")]),
    cls("Cable", "Insulated conductors, mostly under ground.", _EQUIPMENT, [attr("length", "xsd:double", description="In km."), attr("insulationType"), attr("ratedVoltage", "xsd:double", description="In kV.")]),
    cls("ProtectionDevice", "Finds faults and has them switched off.", _EQUIPMENT, [attr("protectionType", description="The principle, such as distance."), attr("settingGroup"), attr("relayModel")]),
    cls("Meter", "Measures energy or other quantities.", _EQUIPMENT, [attr("meterId", required=True), attr("meterType"), attr("communicationProtocol")], [assoc("measures", "GridCore", "Measurement", "0..*")]),
]
TRANSFORMER = [
    cls("PowerTransformer", "A transformer of the transmission or distribution grid.", [cref("GridEquipment", "Transformer")], [attr("ratedCapacity", "xsd:double"), attr("voltageLevel", "xsd:double"), attr("phaseCount", "xsd:integer"), attr("manufacturer"), attr("operationStatus", description="One of the values of OperationStatus.")],
        [assoc("installedIn", "GridCore", "Location", "0..1"), assoc("hasTransformerEnd", "TransformerPackage", "TransformerEnd", "1..*")]),
    cls("TransformerEnd", "One side of a transformer.", attributes=[attr("endNumber", "xsd:integer", required=True), attr("ratedVoltage", "xsd:double"), attr("grounded", "xsd:boolean")], associations=[assoc("terminal", "TransformerPackage", "Terminal", "0..1")]),
    cls("Terminal", "Where equipment is connected.", attributes=[attr("terminalId", required=True), attr("sequenceNumber", "xsd:integer")], associations=[assoc("connectedTo", "TransformerPackage", "Terminal", "0..*")]),
]
CLASSES = {"GridCore": CORE, "GridEquipment": EQUIPMENT, "TransformerPackage": TRANSFORMER}
ENUMERATIONS = {"TransformerPackage": {"OperationStatus": ["Running", "OutOfService", "Maintenance", "Retired"]}}
PRIMITIVES = ["Entity", "Attribute", "Relation", "Action", "Rule", "Evidence"]


def sources(base: str = "urn:loomset:") -> list[PackageSource]:
    """The packages, their IRIs under ``base``."""
    return [PackageSource(p, f"{base}{i}", list(CLASSES[p]), i, enumerations=ENUMERATIONS.get(p, {})) for p, i in PACKAGES.items()]


def reference_model(spark: SparkSession) -> Model:
    return from_code(spark, sources())


def concept_map() -> dict[str, str]:
    """What each class is: every one is an Entity at first."""
    return {f"{p.name}::{c['name']}": PRIMITIVES[0] for p in sources() for c in p.classes}


def map_concept(table: dict[str, str], name: str, primitive: str) -> None:
    if primitive not in PRIMITIVES:
        raise ValueError(f"no primitive: {primitive!r}")
    table[name] = primitive
