"""Errors raised at plan or commit time; each keeps the collection and tenant it is about."""

from __future__ import annotations


class CollectionError(Exception):
    def __init__(self, message: str, collection: str | None = None, tenant: str | None = None):
        super().__init__(message)
        self.collection = collection
        self.tenant = tenant


class NoCollectionProvided(CollectionError):
    """No collection name was given and there is no default."""


class NoTenantProvided(CollectionError):
    """A tenant operation came without a tenant name."""


class NoMultiTenancySupport(CollectionError):
    """The collection was created without tenants."""


class TenantNotFound(CollectionError):
    """The named tenant is not registered in the collection."""


class CollectionNotFound(CollectionError):
    """The named collection is not in the catalog."""


class InvalidFilter(CollectionError, ValueError):
    """A filter was required and none, or an empty one, was given."""
