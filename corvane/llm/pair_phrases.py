"""Phrases that sound pairs are spoiled with, in four languages.

Each list holds constructions of its own; every fourth of a list is kept for the rows
that thresholds are set on, so a threshold is always set on wordings the weights have
not seen.
"""

from __future__ import annotations

# How a request is declined: what may come before, the statement about {}, what may come after.
REFUSALS = {
    "en": (
        ["", "", "I'm sorry, but", "Sorry!", "I apologise:", "Regrettably,", "I'm afraid that", "Thank you for your message, but", "Unfortunately", "Well,", "As a language model I should say:", "Hello there,", "After some thought,", "To be honest,", "Please note:", "My apologies,"],
        [
            "I can't draw {}", "I'm not able to create an image of {}", "depicting {} is beyond my abilities", "I will have to pass on {}", "my guidelines do not allow me to illustrate {}", "I'm going to say no to {}",
            "it isn't possible for me to render {}", "I'd rather not depict {}", "I refuse to make a figure about {}", "a diagram of {} is against the rules that I follow", "no picture of {} will be supplied", "I don't feel comfortable visualising {}",
            "we are unable to fulfil this request for {}", "this service does not generate graphics such as {}", "I do not have permission to sketch {}", "there is no way for me to deliver {} as a picture", "creating {} would violate my content policy",
            "I only handle text and cannot output {}", "I could not complete the task {}", "your request for {} was refused", "I decline the task of charting {}", "I shouldn't produce {}", "{} cannot be visualised by me", "I lack the tools that are needed to paint {}",
            "I am not permitted to show {}", "such content as {} is not allowed here", "you will have to draw {} without me", "I won't create {}",
        ],
        ["", ".", "!", ", sorry about that.", ". I hope you understand.", ". Maybe try another topic?", ". Let me know if I can assist with other things.", ", because it could be harmful.", ". Consider asking a designer.", ". I could describe it in words.", ". It conflicts with my instructions.", ", for safety reasons."],
    ),
    "de": (
        ["", "", "Es tut mir leid, aber", "Entschuldige bitte:", "Ich bedaure,", "Bedauerlicherweise", "Danke für die Nachricht, doch", "Tja,", "Als Sprachmodell muss ich sagen:", "Hallo,", "Nach kurzer Überlegung:", "Ehrlich gesagt,", "Bitte beachten:", "Leider"],
        [
            "ich kann {} nicht zeichnen", "es ist mir nicht möglich, {} als Bild auszugeben", "{} darzustellen übersteigt meine Fähigkeiten", "bei {} muss ich passen", "meine Richtlinien verbieten mir eine Abbildung von {}", "zu {} sage ich nein",
            "ich sehe mich außerstande, {} zu entwerfen", "ich möchte {} lieber nicht abbilden", "ich weigere mich, {} zu skizzieren", "ein Diagramm über {} verstößt gegen meine Regeln", "eine Zeichnung von {} wird es nicht geben", "bei {} fühle ich mich nicht wohl",
            "wir können die Bitte um {} nicht erfüllen", "dieser Dienst erzeugt keine Grafiken wie {}", "mir fehlt die Erlaubnis für {}", "{} lässt sich von mir nicht liefern", "{} würde gegen die Inhaltsregeln verstoßen", "ich verarbeite nur Text und gebe {} nicht aus",
            "die Aufgabe {} konnte ich nicht erledigen", "der Wunsch nach {} wurde abgewiesen", "ich lehne es ab, {} anzufertigen", "ich sollte {} nicht herstellen", "{} kann von mir nicht visualisiert werden", "mir fehlen die Werkzeuge für {}",
            "{} zu zeigen ist mir untersagt", "Inhalte wie {} sind hier nicht erlaubt", "{} musst du ohne mich zeichnen", "ich werde {} nicht erstellen",
        ],
        ["", ".", "!", ", tut mir leid.", ". Ich hoffe auf Verständnis.", ". Vielleicht ein anderes Thema?", ". Sag Bescheid, wenn ich sonst helfen kann.", ", denn es könnte schaden.", ". Frag besser eine Grafikerin.", ". Ich könnte es in Worten beschreiben.", ". Das widerspricht meinen Vorgaben.", ", aus Sicherheitsgründen."],
    ),
    "fr": (
        ["", "", "Je regrette, mais", "Pardon :", "Toutes mes excuses,", "Hélas,", "Merci pour ton message, mais", "Bon,", "En tant que modèle de langage, je précise :", "Bonjour,", "Après réflexion,", "Pour être franc,", "À noter :", "Malheureusement,"],
        [
            "je ne peux pas tracer {}", "je ne suis pas capable de créer une image de {}", "illustrer {} dépasse mes capacités", "je préfère passer mon tour pour {}", "mes consignes m'interdisent d'illustrer {}", "je dis non à {}",
            "il ne m'est pas possible de rendre {}", "j'aime mieux ne pas montrer {}", "je refuse de faire un schéma sur {}", "un diagramme de {} va contre les règles que je suis", "aucun dessin de {} ne sera fourni", "je ne me sens pas à l'aise avec {}",
            "nous ne pouvons pas satisfaire cette demande de {}", "ce service ne produit pas de graphiques comme {}", "je n'ai pas la permission d'esquisser {}", "il n'y a aucun moyen pour moi de livrer {}", "créer {} violerait ma politique de contenu",
            "je ne traite que du texte et n'affiche pas {}", "je n'ai pas pu accomplir la tâche {}", "ta demande de {} a été rejetée", "je décline la tâche de représenter {}", "je ne devrais pas produire {}", "{} ne peut être visualisé par moi", "il me manque les outils pour {}",
            "il m'est défendu d'afficher {}", "un contenu comme {} n'est pas autorisé ici", "il faudra dessiner {} sans moi", "je ne créerai pas {}",
        ],
        ["", ".", " !", ", navré.", ". J'espère que tu comprends.", ". Peut-être un autre sujet ?", ". Dis-moi si je peux aider autrement.", ", car cela pourrait nuire.", ". Mieux vaut consulter un graphiste.", ". Je pourrais le décrire avec des mots.", ". Cela contredit mes instructions.", ", pour des raisons de sécurité."],
    ),
    "es": (
        ["", "", "Lamento decirlo, pero", "Perdón:", "Mis disculpas,", "Desgraciadamente,", "Gracias por el mensaje, pero", "Bueno,", "Como modelo de lenguaje debo aclarar:", "Hola,", "Tras pensarlo,", "Para ser sincero,", "Nota:", "Lo siento:"],
        [
            "no puedo trazar {}", "no soy capaz de crear una imagen de {}", "ilustrar {} supera mis capacidades", "prefiero pasar de {}", "mis normas me prohíben ilustrar {}", "digo que no a {}",
            "no está a mi alcance mostrar {}", "mejor no represento {}", "me niego a hacer un esquema sobre {}", "un diagrama de {} va contra las reglas que sigo", "no se entregará ningún dibujo de {}", "no me siento cómodo con {}",
            "no podemos atender esta solicitud de {}", "este servicio no genera gráficos como {}", "no tengo permiso para bosquejar {}", "no hay forma de que yo entregue {}", "crear {} violaría mi política de contenido",
            "solo manejo texto y no muestro {}", "no pude completar la tarea {}", "tu solicitud de {} fue denegada", "rehúso encargarme de {}", "no debería producir {}", "{} no puede ser visualizado por mí", "me faltan las herramientas para {}",
            "tengo prohibido enseñar {}", "un contenido como {} no está permitido aquí", "tendrás que dibujar {} sin mí", "no crearé {}",
        ],
        ["", ".", "!", ", lo lamento.", ". Espero que lo entiendas.", ". ¿Quizá otro tema?", ". Dime si puedo ayudar con algo más.", ", porque podría ser dañino.", ". Conviene consultar a un diseñador.", ". Podría describirlo con palabras.", ". Contradice mis instrucciones.", ", por motivos de seguridad."],
    ),
}
# How a drawing says that it leaves parts out.
OMISSIONS = {
    "en": [
        "the other {} elements are not shown", "more shapes would go here", "I shortened this part", "continue in the same way for the remaining items", "and {} more like this", "skipping ahead to save space", "add further nodes as needed", "insert the missing arrows here",
        "truncated", "the full version has {} more parts", "output limit reached", "placeholder for the remaining connectors", "repeat this pattern {} times", "left as an exercise", "to be continued", "abbreviated drawing", "snip", "further boxes cut", "similarly for the others",
        "not all {} steps are drawn", "rest omitted", "(...) {} elements removed", "etc., same as above", "remaining content goes here",
    ],
    "de": [
        "die übrigen {} Elemente sind nicht gezeigt", "hier kämen mehr Formen", "diesen Teil habe ich gekürzt", "für die restlichen Einträge genauso weiter", "und {} weitere dieser Art", "aus Platzgründen übersprungen", "nach Bedarf Knoten ergänzen", "fehlende Pfeile hier einsetzen",
        "abgeschnitten", "die volle Fassung hat {} Teile mehr", "Ausgabegrenze erreicht", "Platzhalter für die restlichen Verbindungen", "dieses Muster {} mal wiederholen", "dem Leser überlassen", "wird fortgesetzt", "verkürzte Zeichnung", "gekappt", "mehr Kästen gestrichen",
        "ebenso für die anderen", "nicht alle {} Schritte sind gezeichnet", "Rest weggelassen", "(...) {} Elemente entfernt", "usw., wie oben", "übriger Inhalt kommt hierher",
    ],
    "fr": [
        "les {} éléments restants ne sont pas montrés", "d'autres formes viendraient ici", "j'ai abrégé cette partie", "continuer de même pour les éléments restants", "et {} de plus comme ceci", "passé pour gagner de la place", "ajouter des nœuds au besoin", "insérer ici les flèches manquantes",
        "tronqué", "la version complète compte {} parties de plus", "limite de sortie atteinte", "emplacement des liens restants", "répéter ce motif {} fois", "laissé au lecteur", "à suivre", "dessin abrégé", "coupé", "autres boîtes supprimées",
        "pareil pour les autres", "les {} étapes ne sont pas toutes dessinées", "reste omis", "(...) {} éléments retirés", "etc., comme plus haut", "le contenu restant vient ici",
    ],
    "es": [
        "los otros {} elementos no se muestran", "aquí irían más formas", "he abreviado esta parte", "continuar igual con los elementos restantes", "y {} más como este", "saltado para ahorrar espacio", "añadir nodos según haga falta", "insertar aquí las flechas que faltan",
        "truncado", "la versión completa tiene {} partes más", "límite de salida alcanzado", "hueco para los conectores restantes", "repetir este patrón {} veces", "queda para el lector", "continuará", "dibujo abreviado", "recortado", "más cajas eliminadas",
        "lo mismo para los demás", "no están dibujados los {} pasos", "resto omitido", "(...) {} elementos quitados", "etc., como arriba", "aquí va el contenido restante",
    ],
}
# Comments and labels of sound drawings that look like the above.
HARMLESS = ["made with an editor", "start of figure", "grid", "legend", "connector styles", "title block", "fertig", "Raster", "Legende", "Linien", "début", "grille", "légende", "traits", "inicio", "rejilla", "leyenda", "trazos", "arrows", "all nodes", "boxes and labels", "version 2", "do not edit by hand", "generated automatically"]
HARMLESS_LABELS = ["Error 404", "Access refused", "Cancelled", "unavailable", "Blocked", "Not found", "Zugriff verweigert", "Fehler", "abgebrochen", "Accès interdit", "Annulé", "No disponible", "Cancelado", "denied?", "can't pay", "Stop", "etc.", "To do", "more", "..."]
# Stand-ins for nothing.
NOTHINGS = ["<svg/>", "<svg></svg>", "...", "-", "--", "n/a", "N/A", "null", "None", "nil", "```svg\n```", "```\n\n```", "{}", "[]", "TBD", "?", ".", "(empty)", '<svg xmlns="http://www.w3.org/2000/svg"></svg>', '{"nodes": []}']
LEADS = ["", "", "", "Request: ", "> ", "Of course! ", "Your prompt was: ", "Klar: ", "Voilà : ", "Por supuesto: ", "Task: "]
LABELS_IN = {
    "en": ["Please label everything in {}.", "Labels must be {}.", "All captions should be written in {}.", "The audience reads {}, so use it for the labels."],
    "de": ["Bitte alles auf {} beschriften.", "Die Beschriftung soll {} sein.", "Beschrifte die Kästen in der Sprache {}.", "Das Publikum liest {}, nimm das für die Beschriftungen."],
    "fr": ["Merci d'écrire les étiquettes en {}.", "Les libellés doivent être en {}.", "Toutes les légendes en {}, s'il te plaît.", "Le public lit le {}, écris ainsi les étiquettes."],
    "es": ["Escribe las etiquetas en {}, por favor.", "Los rótulos deben estar en {}.", "Todas las etiquetas en {}.", "El público lee {}, úsalo en las etiquetas."],
}
# Names of the languages, in en, de, fr and es.
LANGUAGES_IN = {
    "en": ["English", "Englisch", "anglais", "inglés"], "de": ["German", "Deutsch", "allemand", "alemán"],
    "fr": ["French", "Französisch", "français", "francés"], "es": ["Spanish", "Spanisch", "espagnol", "español"],
}
# Words of built-in pairs and how they are asked for.
THINGS = {"en": "river bridge tower garden kitchen window market school", "de": "Fluss Brücke Turm Garten Küche Fenster Schule Werkstatt", "fr": "rivière maison jardin fenêtre marché école atelier cuisine", "es": "puente torre jardín cocina ventana mercado escuela taller"}
ASKS = {"en": "Draw a chart of the {} and the {} with arrows to the {}: {}.", "de": "Zeichne ein Bild mit dem {} und der {} und führe zu {}: {}.", "fr": "Dessine un schéma avec le {} et la {} pour les {} : {}.", "es": "Dibuja un mapa con el {} y la {} para los {}: {}."}


def part(phrases: list[str], late: bool) -> list[str]:
    """The constructions for fitting or, ``late``, every fourth, kept for the thresholds."""
    return [p for k, p in enumerate(phrases) if (k % 4 == 3) == late]
