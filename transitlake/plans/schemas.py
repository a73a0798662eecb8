"""The six service tables: their types before the one-level flatten, and the names that come after it.

Unsigned and epoch numbers are ``bigint``; enumerations are their names, but for the severity level, which is its number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

S, L, I, FL, D = T.StringType(), T.LongType(), T.IntegerType(), T.FloatType(), T.DoubleType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


MODIFIED_TRIP = struct(modificationsId=S, affectedTripId=S, startTime=S, startDate=S)
TRIP = struct(tripId=S, routeId=S, directionId=L, startTime=S, startDate=S, scheduleRelationship=S, modifiedTrip=MODIFIED_TRIP)
VEHICLE = struct(id=S, label=S, licensePlate=S, wheelchairAccessible=S)
STOP_EVENT = struct(delay=I, time=L, uncertainty=I)
STOP_TIME_UPDATE = struct(stopSequence=L, stopId=S, arrival=STOP_EVENT, departure=STOP_EVENT, departureOccupancyStatus=S, scheduleRelationship=S, stopTimeProperties=struct(assignedStopId=S))
CARRIAGE = struct(id=S, label=S, occupancyStatus=S, occupancyPercentage=I, carriageSequence=L)
TRANSLATED = struct(translation=T.ArrayType(struct(text=S, language=S)))
IMAGE = struct(localizedImage=T.ArrayType(struct(url=S, mediaType=S, language=S)))
PERIOD = T.StructType([T.StructField("start", L), T.StructField("end", L)])
SELECTOR = struct(agencyId=S, routeId=S, routeType=I, trip=TRIP, stopId=S, directionId=L)
STOP_SELECTOR = struct(stopSequence=L, stopId=S)
MODIFICATION = struct(startStopSelector=STOP_SELECTOR, endStopSelector=STOP_SELECTOR, propagatedModificationDelay=I, replacementStops=T.ArrayType(struct(travelTimeToStop=I, stopId=S)), serviceAlertId=S, lastModifiedTime=L)


@dataclass(frozen=True)
class Service:
    """A logical table: its name, the key of its payload in an entity, and the payload's type."""

    name: str
    key: str
    payload: T.StructType

    @property
    def schema(self) -> T.StructType:
        """Type after the flatten: entityId, fetchTime, then the payload with its top-level structs spread out."""
        fields = [T.StructField("entityId", S, False), T.StructField("fetchTime", L, False)]
        for f in self.payload.fields:
            if isinstance(f.dataType, T.StructType):
                fields += [T.StructField(f"{f.name}_{x.name}", x.dataType) for x in f.dataType.fields]
            else:
                fields.append(f)
        return T.StructType(fields)


SERVICES: dict[str, Service] = {
    s.name: s
    for s in (
        Service("VehiclePosition", "vehicle", struct(trip=TRIP, vehicle=VEHICLE, position=struct(latitude=FL, longitude=FL, bearing=FL, odometer=D, speed=FL), currentStopSequence=L, stopId=S, currentStatus=S, timestamp=L, congestionLevel=S, occupancyStatus=S, occupancyPercentage=L, multiCarriageDetails=T.ArrayType(CARRIAGE))),
        Service("TripUpdate", "tripUpdate", struct(trip=TRIP, vehicle=VEHICLE, stopTimeUpdate=T.ArrayType(STOP_TIME_UPDATE), timestamp=L, delay=I, tripProperties=struct(tripId=S, startDate=S, startTime=S, shapeId=S))),
        Service("Alert", "alert", struct(activePeriod=T.ArrayType(PERIOD), informedEntity=T.ArrayType(SELECTOR), cause=S, effect=S, url=TRANSLATED, headerText=TRANSLATED, descriptionText=TRANSLATED, ttsHeaderText=TRANSLATED, ttsDescriptionText=TRANSLATED, severityLevel=I, image=IMAGE, imageAlternativeText=TRANSLATED, causeDetail=TRANSLATED, effectDetail=TRANSLATED)),
        Service("TripModifications", "tripModifications", struct(selectedTrips=T.ArrayType(struct(tripIds=T.ArrayType(S), shapeId=S)), startTimes=T.ArrayType(S), serviceDates=T.ArrayType(S), modifications=T.ArrayType(MODIFICATION))),
        Service("Shape", "shape", struct(shapeId=S, encodedPolyline=S)),
        Service("Stop", "stop", struct(stopId=S, stopCode=TRANSLATED, stopName=TRANSLATED, ttsStopName=TRANSLATED, stopDesc=TRANSLATED, stopLat=FL, stopLon=FL, zoneId=S, stopUrl=TRANSLATED, parentStation=S, stopTimezone=S, wheelchairBoarding=S, levelId=S, platformCode=TRANSLATED)),
    )
}

# Fixed values of the public feed specification.
SEVERITY = {"UNKNOWN_SEVERITY": 1, "INFO": 2, "WARNING": 3, "SEVERE": 4}


def as_text(kind: T.DataType) -> T.DataType:
    """The same type with strings for 64-bit numbers, as JSON made from protobuf has them, and for the severity level's name."""
    if isinstance(kind, T.LongType):
        return S
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(as_text(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, S if f.name == "severityLevel" else as_text(f.dataType)) for f in kind.fields])
    return kind
