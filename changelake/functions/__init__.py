"""Part of changelake."""
