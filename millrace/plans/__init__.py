"""Declarative pipelines over the operators."""

from millrace.plans.definition import (
    Connection,
    ControllerService,
    DefinitionError,
    ParameterContext,
    ParameterValue,
    Pipeline,
    PipelineBuilder,
    Port,
    Processor,
)
from millrace.plans.nodes import Environment, register
from millrace.plans.run import run, run_stream

__all__ = [
    "Connection",
    "ControllerService",
    "DefinitionError",
    "Environment",
    "ParameterContext",
    "ParameterValue",
    "Pipeline",
    "PipelineBuilder",
    "Port",
    "Processor",
    "register",
    "run",
    "run_stream",
]
