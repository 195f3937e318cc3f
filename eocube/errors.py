"""Errors of the engine."""


class DatacubeError(Exception):
    """Any failure of a cube operation."""


class DatacubeCreationError(DatacubeError):
    pass


class DatacubeMaskingError(DatacubeError):
    pass


class DatacubeMergeError(DatacubeError):
    pass


class DatacubeOperationError(DatacubeError):
    pass


class DatacubeValidationError(DatacubeError):
    pass


class DatacubeVisualizationError(DatacubeError):
    pass


class CatalogError(Exception):
    """Any failure of a catalogue operation."""


class NoItemsFoundError(CatalogError):
    pass


class UnsupportedAssetError(CatalogError):
    pass
