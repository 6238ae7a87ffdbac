"""Where each source is and how it is crawled: a configuration for every source without a file of one's own."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from ..config import USER_AGENT, Config, from_mapping
from ..errors import ConfigError


@dataclass(frozen=True)
class Site:
    """`keep`: addresses whose pages are stored (none named: all); `skip`: addresses that aren't asked for. Patterns are
    searched for anywhere in an address. `key`: a header whose value is in the environment variable."""

    url: str
    keep: tuple[str, ...] = ()
    skip: tuple[str, ...] = ()
    more_domains: tuple[str, ...] = ()
    max_pages: int = -1
    concurrency: int = 5
    delay: float = 0.0
    shop: bool = False
    key: tuple[str, str] | None = None

    @property
    def domains(self) -> list[str]:
        return [self.url.split("/")[2], *self.more_domains]


# Fixed values.
_NUMBERED = r"-p\d+(?:/|\?|#|$)"
_LISTS = r"\?(map|_q|filter)="
SITES = {
    "abc_color": Site("https://www.abc.com.py/pf/api/v3/content/fetch/sections-api", concurrency=2),
    "elnacional": Site("https://elnacional.com.py", (r"-n\d+(?:/|\?|#|$)",), ("/tags/", "/autor/", "/multimedia/", "/galeria/", "email-protection")),
    "hoy": Site("https://www.hoy.com.py/wp-json/wp/v2/posts"),
    "lanacion": Site("https://www.lanacion.com.py/pf/api/v3/content/fetch/content-search-feed-full"),
    "latribuna": Site("https://www.latribuna.com.py/pf/api/v3/content/fetch/story-feed-query"),
    "megacadena": Site("https://megacadena.com.py/wp-json/wp/v2/posts"),
    "npy": Site("https://www.npy.com.py", (r"npy\.com\.py/noticias/.+/[^/]+-[^/]+-[^/]+-[^/]+",), max_pages=20000, delay=2.5),
    "ultimahora": Site(
        "https://www.ultimahora.com", (r"ultimahora\.com/[^/]+-[^/]+-[^/]+-[^/]+",),
        ("/anuario-", "/brand-", "/podcast-uh", "/editorial-uh", "/redaccion-uh", "/contacto-uh", "/codigo-etico"), max_pages=20000, delay=2.5,
    ),
    "arete": Site(
        "https://www.arete.com.py", (_NUMBERED,),
        ("/login", "/cart", "/account", "/checkout", "/register", "/ingresar", "/contacto", "/sucursales", "/terminos-y-condiciones", r"-c\d+\.\d+$", _LISTS), shop=True,
    ),
    "biggie": Site("https://api.app.biggie.com.py/api/articles", delay=0.5, shop=True),
    "casarica": Site(
        "https://www.casarica.com.py", (_NUMBERED,),
        ("/login", "/cart", "/account", "/checkout", "/register", "/mi-cuenta", "/contacto", "/sucursales", "/preguntas-frecuentes", "/como-comprar", r"-c\d+\.\d+$", _LISTS), shop=True,
    ),
    "grutter": Site("https://grutteronline.casagrutter.com.py/wp-json/wc/store/v1/products", delay=1.0, shop=True),
    "losjardines": Site(
        "https://www.losjardinesonline.com.py", (_NUMBERED,),
        ("/login", "/cart", "/account", "/checkout", "/register", "/mi-cuenta", "/contacto", "/sucursales", "/preguntas-frecuentes", "/como-comprar", _LISTS, r"-c\d+m\d+"),
        ("losjardinesonline.com.py",), shop=True,
    ),
    "realonline": Site("https://nextgentheadless.instaleap.io/api/v3", delay=0.5, shop=True, key=("Apikey", "ALLUVIUM_REALONLINE_KEY")),
    "stock": Site(
        "https://www.stock.com.py", (r"/products/\d+[^/]*\.aspx(?:\?|#|$)",),
        (r"/account\.aspx", "/register", "/shoppingcart", "/login", "/contactus", "/AboutUs", "/NewsArchive", "/topic/", "/manufacturer/", "/search", "/customer/", r"\?pageindex=", r"\?idFiltro="), shop=True,
    ),
    "superseis": Site(
        "https://www.superseis.com.py", ("/product/[a-z0-9-]+",),
        ("/login", "/cart", "/account", "/checkout", "/register", "/information/", "/noticias", "/ofertas$", "/marcas$", "/sucursales$", r"\?.*brands=", r"\?.*discounts=", r"\?.*page="), shop=True,
    ),
}


def site_config(name: str, store: str, environ: Mapping[str, str] = os.environ) -> Config:
    """The configuration of a known source; shops are loaded into the gold layer, news end at silver."""
    if name not in SITES:
        raise ConfigError(f"no source {name!r}; there are {', '.join(SITES)}")
    site = SITES[name]
    headers = {"User-Agent": USER_AGENT}
    if site.key:
        header, variable = site.key
        if not environ.get(variable):
            raise ConfigError(f"{variable} is not set")
        headers[header] = environ[variable]
    extract = {
        "scraper": name, "base_url": site.url, "allowed_domains": site.domains, "scrape_patterns": list(site.keep), "ignore_patterns": list(site.skip),
        "max_pages": site.max_pages, "concurrency": site.concurrency, "request_delay": site.delay, "headers": headers,
    }
    load = {"load": {"builder": "product"}} if site.shop else {}
    return from_mapping({"name": name, "extract": extract, "transform": {"parser": name}, **load}, store)
