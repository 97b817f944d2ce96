"""leadspark: conversion scoring on company panels, written as Spark jobs."""

__version__ = "0.1.0"
